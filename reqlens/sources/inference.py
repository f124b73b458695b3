"""Column types of a text table, from counts that add up.

One aggregate folds every text column into a small lattice::

    long  <  double  <  string          timestamp  <  string

For each column it counts the filled values and those that read as a long, a double or a
timestamp; the least type that takes *all* filled values is the column's.  Such counts of two
sets of files add up to the counts of both (:func:`merge_type_counts`), so arriving files need
no second look at earlier ones.

A number must survive the round trip to be one: ``00123`` or ``+7`` would come back changed, so codes with leading
zeros stay text, whatever their column is called.  Identifier columns are exempt and stay text.
A column without any filled value is text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.functions.dates import parse_timestamp
from reqlens.roles import IDENTIFIER_COLUMNS, RAW_DATE_PATTERN

LONG = r"^-?(0|[1-9][0-9]*)$"
DOUBLE = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"

COUNTS = ("filled", "as_long", "as_double", "as_timestamp")


def _tests(c: Column, pattern: str, zone: str | None) -> dict[str, Column]:
    is_double = c.rlike(DOUBLE) & F.coalesce(F.abs(c.try_cast("double")) < float("inf"), F.lit(False))
    # a number is no date: most values of a number column cost no date parse
    is_time = F.when(is_double, F.lit(False)).otherwise(parse_timestamp(c, pattern, zone).isNotNull())
    return {
        "filled": c.isNotNull(),
        "as_long": c.rlike(LONG) & c.try_cast("long").isNotNull(),
        "as_double": is_double,
        "as_timestamp": is_time,
    }


def type_counts(df: DataFrame, columns: Iterable[str] | None = None, pattern: str = RAW_DATE_PATTERN) -> DataFrame:
    """``column_name, filled, as_long, as_double, as_timestamp`` of each text column: one pass, one row per column."""
    text = [c for c, t in df.dtypes if t == "string" and (columns is None or c in set(columns))]
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
    tests = {c: _tests(F.col(f"`{c}`"), pattern, zone) for c in text}
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(t[k]).alias(f"{k}_{i}") for i, t in enumerate(tests.values()) for k in COUNTS])
    lines = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in COUNTS]) for i, c in enumerate(tests)]
    if not lines:
        return df.sparkSession.createDataFrame([], "column_name string, " + ", ".join(f"{k} long" for k in COUNTS))
    return row.select(F.inline(F.array(*lines)))


def merge_type_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several sets of rows as the counts of all of them."""
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    return every.groupBy("column_name").agg(*[F.sum(k).alias(k) for k in COUNTS])


def with_types(counts: DataFrame, identifiers: Iterable[str] = IDENTIFIER_COLUMNS) -> DataFrame:
    """``counts`` with ``data_type``: the least type of the lattice that takes all filled values."""
    takes = lambda k: F.col(k) == F.col("filled")
    kind = (
        F.when((F.col("filled") == 0) | F.col("column_name").isin(list(identifiers)), "string")
        .when(takes("as_long"), "bigint")
        .when(takes("as_double"), "double")
        .when(takes("as_timestamp"), "timestamp_ntz")
        .otherwise("string")
    )
    return counts.withColumn("data_type", kind)


def inferred_schema(
    df: DataFrame, identifiers: Iterable[str] = IDENTIFIER_COLUMNS, pattern: str = RAW_DATE_PATTERN
) -> DataFrame:
    """``column_name, filled, as_long, as_double, as_timestamp, data_type`` of each text column."""
    return with_types(type_counts(df, pattern=pattern), identifiers)


def cast_columns(df: DataFrame, types: Mapping[str, str], pattern: str = RAW_DATE_PATTERN) -> DataFrame:
    """``df`` with its text columns cast to ``types`` (column -> data_type), in one projection.

    A value that its type does not take (rows that arrived after the types were settled) becomes NULL.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
    casts = {}
    for c, t in df.dtypes:
        wanted = types.get(c, t)
        if t == "string" and wanted != "string":
            col = F.col(f"`{c}`")
            casts[c] = parse_timestamp(col, pattern, zone) if wanted == "timestamp_ntz" else col.try_cast(wanted)
    return df.withColumns(casts) if casts else df


def settled_types(schema: DataFrame) -> dict[str, str]:
    """column -> data_type of an :func:`inferred_schema` (one row per column reaches the driver)."""
    return {r["column_name"]: r["data_type"] for r in schema.select("column_name", "data_type").collect()}


def infer_types(
    df: DataFrame, identifiers: Iterable[str] = IDENTIFIER_COLUMNS, pattern: str = RAW_DATE_PATTERN
) -> DataFrame:
    """``df`` with each text column as the least type that takes all its values: one pass before the result's own."""
    return cast_columns(df, settled_types(inferred_schema(df, identifiers, pattern)), pattern)


def stored_type_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts written batch by batch (``batch_id=<n>`` directories, see ``streaming``), merged."""
    return merge_type_counts(spark.read.parquet(path).drop("batch_id"))
