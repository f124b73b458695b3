"""reqlens: Spark-native analytics for request-like tables.

One row per request (ticket, incident, order) with a key, opened and closed
times, a status, a category, a region and a handler.  Everything here builds
lazy Spark DataFrames; nothing is collected except one-row gate metrics.

Subpackages:

* ``sources``   – CSV / Parquet sources and sinks, the column contract, and the
                  test-table adapter that derives a request table.
* ``functions`` – exact rounding and timestamp helpers (Column -> Column).
* ``operators`` – quality profile, cleaning rules, derived features, gates,
                  summaries (DataFrame -> DataFrame).
* ``plans``     – the parameterised analyses and the end-to-end pipeline.
* ``streaming`` – incremental runs of the row-level stages over a file stream.
* ``cli``       – ``python -m reqlens ingest|inspect|clean|transform|analyze|pipeline``.
* ``oracle``    – DuckDB SQL twins of the registered queries (correctness checks).
"""

from reqlens.roles import DEFAULT_ROLES, Roles

__all__ = ["DEFAULT_ROLES", "Roles"]
__version__ = "0.1.0"
