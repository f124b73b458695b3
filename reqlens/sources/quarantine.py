"""Split raw CSV records into good ones and quarantined ones, in one write.

Each record is judged once.  A good one goes on with its columns; a bad one keeps the whole
line, the file it came from and every reason, so that it can be mended and loaded again::

    out/accepted=true/...     role columns
    out/accepted=false/...    role columns as far as they were read, record, source_file, reasons

Reasons: ``fields`` (too few or too many, or broken quoting), ``missing:<role>`` (a column that must be
filled is not), ``number:<role>`` and ``date:<role>`` (text that is none).  Which of them quarantine a
record is a parameter; by default broken records and those without a key do, while a stray bad number becomes
NULL, as :func:`reqlens.sources.files.read_raw_csv` has it.  Counts of all records, of good ones and of each reason are
observed by the write, so nothing is read twice, and records in = good + quarantined is checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reqlens.functions.dates import parse_timestamp
from reqlens.roles import DEFAULT_ROLES, RAW_DATE_PATTERN, RAW_NUMERIC_TYPES, SOURCE_HEADER_ROLES, Roles
from reqlens.sources.files import CORRUPT, _cast_numeric_roles, _raw_text, cast_identifiers, rename_to_roles, validate_columns

JUDGED = ("accepted", "record", "source_file", "reasons")


@dataclass(frozen=True)
class Rules:
    """What sends a record to quarantine."""

    broken: bool = True
    filled: tuple[str, ...] = (DEFAULT_ROLES.key,)
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()

    def reasons(self, df: DataFrame, pattern: str) -> dict[str, Column]:
        """Reason -> whether it holds, over text columns of ``df``."""
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
        found: dict[str, Column] = {"fields": F.col(CORRUPT).isNotNull()} if self.broken else {}
        for c in self.filled:
            found[f"missing:{c}"] = F.col(c).isNull() | (F.trim(c) == "")
        for c in self.numbers:
            found[f"number:{c}"] = F.col(c).isNotNull() & F.col(c).try_cast(RAW_NUMERIC_TYPES.get(c, "double")).isNull()
        for c in self.dates:
            found[f"date:{c}"] = F.col(c).isNotNull() & parse_timestamp(F.col(c), pattern, zone).isNull()
        return found


def judged_records(
    spark: SparkSession,
    path: str,
    rules: Rules = Rules(),
    header_roles: Mapping[str, str] = SOURCE_HEADER_ROLES,
    numeric_types: Mapping[str, str] = RAW_NUMERIC_TYPES,
    roles: Roles = DEFAULT_ROLES,
    multiline: bool = False,
    pattern: str = RAW_DATE_PATTERN,
) -> DataFrame:
    """Every record of the CSV at ``path``: role columns, accepted, and for bad ones record, source_file, reasons.

    ``record`` is the whole line of a broken record, and for others the values that were read, as JSON.
    """
    raw = rename_to_roles(_raw_text(spark, path, multiline, prune=False), {**header_roles, CORRUPT: CORRUPT})
    validate_columns(raw, roles)
    columns = [c for c in raw.columns if c != CORRUPT]
    found = rules.reasons(raw, pattern)
    why = F.array_compact(F.array(*[F.when(held, F.lit(name)) for name, held in found.items()], F.lit(None).cast("string")))
    judged = raw.select("*", F.col("_metadata.file_path").alias("source_file"), why.alias("reasons"))
    bad = F.size("reasons") > 0
    values = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*columns)))
    judged = judged.select(
        *columns,
        (~bad).alias("accepted"),
        F.when(bad, values).alias("record"),
        F.when(bad, F.col("source_file")).alias("source_file"),
        F.when(bad, F.col("reasons")).alias("reasons"),
    )
    return cast_identifiers(_cast_numeric_roles(judged, numeric_types))


def split_raw_csv(spark: SparkSession, path: str, out_dir: str, rules: Rules = Rules(), **reading) -> dict[str, int]:
    """Write good and quarantined records of ``path`` under ``out_dir`` in one job; counts of both and of each reason."""
    judged = judged_records(spark, path, rules, **reading)
    names = [name for name, on in (("fields", rules.broken),) if on]
    names += [f"{kind}:{c}" for kind, columns in (("missing", rules.filled), ("number", rules.numbers), ("date", rules.dates)) for c in columns]
    seen = Observation(f"quarantine-{uuid.uuid4().hex[:12]}")
    counts = [
        F.count(F.lit(1)).alias("records"),
        F.count_if("accepted").alias("good"),
        F.count_if(~F.col("accepted")).alias("quarantined"),
        *[F.count_if(F.coalesce(F.array_contains("reasons", n), F.lit(False))).alias(n) for n in names],
    ]
    judged.observe(seen, *counts).write.mode("overwrite").partitionBy("accepted").parquet(out_dir)
    got = dict(seen.get)
    if got["records"] != got["good"] + got["quarantined"]:
        raise ValueError(f"records lost on the way to quarantine: {got}")
    return got


def _side(spark: SparkSession, out_dir: str, accepted: bool, columns: Iterable[str]) -> DataFrame:
    # the filter on the partition column prunes the other side's directory
    return spark.read.parquet(out_dir).where(F.col("accepted").cast("boolean") == accepted).drop(*columns)


def good_records(spark: SparkSession, out_dir: str) -> DataFrame:
    return _side(spark, out_dir, True, JUDGED)


def quarantined_records(spark: SparkSession, out_dir: str) -> DataFrame:
    return _side(spark, out_dir, False, ("accepted",))


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    """``source_file, reason, records``: a record counts under each of its reasons."""
    each = quarantined.select("source_file", F.explode("reasons").alias("reason"))
    return each.groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("records"))
