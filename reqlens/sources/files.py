"""CSV / Parquet sources and sinks.

The raw export is read without the reader's schema inference, which turns
identifier columns such as ZIP codes into integers, dropping leading zeros.
Every column is read as text (the header alone names them), renamed to its
role, and the few numeric roles are cast with ``try_cast`` so a stray bad value
becomes NULL rather than failing the job.  ``infer=True`` types the other
columns by :mod:`reqlens.sources.inference`; that is one more pass over the
input, so it is not the default.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqlens.operators.quality import structure_profile
from reqlens.roles import (
    DEFAULT_ROLES,
    IDENTIFIER_COLUMNS,
    RAW_NUMERIC_TYPES,
    SOURCE_HEADER_ROLES,
    Roles,
    present,
    snake_case,
)
from reqlens.sources.inference import infer_types


def rename_to_roles(df: DataFrame, header_roles: Mapping[str, str] = SOURCE_HEADER_ROLES) -> DataFrame:
    """Rename source headers to role names in one projection (unknown headers -> snake_case)."""
    mapping = {c: header_roles.get(c, snake_case(c)) for c in df.columns}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def cast_identifiers(df: DataFrame, columns: Iterable[str] = IDENTIFIER_COLUMNS) -> DataFrame:
    """Identifier columns as text (a no-op when they were read as text)."""
    cols = present(df.columns, columns)
    return df.withColumns({c: F.col(c).cast("string") for c in cols}) if cols else df


def _cast_numeric_roles(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    cols = {c: t for c, t in types.items() if c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in cols.items()}) if cols else df


CORRUPT = "_corrupt_record"


def csv_options(multiline: bool = False) -> dict[str, object]:
    """Reader options of raw exports, batch and stream alike.

    RFC 4180 quoting (a quote inside a quoted field is doubled).  Each file's
    header must match the schema in names and order (``enforceSchema``
    false): a file with other columns stops the read instead of landing in
    the wrong ones.
    """
    return {
        "header": True,
        "mode": "PERMISSIVE",
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "enforceSchema": False,
        "columnNameOfCorruptRecord": CORRUPT,
    }


def _raw_text(spark: SparkSession, path: str, multiline: bool, prune: bool = True) -> DataFrame:
    """All columns as text, plus the whole record where it is malformed (too few or too many fields).

    With ``prune`` the parser skips unread fields, and then sees no malformed records either.
    """
    reader = spark.read.options(**csv_options(multiline)).option("columnPruning", prune)
    try:
        header = reader.csv(path).columns
        schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, CORRUPT]])
        return reader.schema(schema).csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"no CSV at {path}") from exc
        raise


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header_roles: Mapping[str, str] = SOURCE_HEADER_ROLES,
    numeric_types: Mapping[str, str] = RAW_NUMERIC_TYPES,
    roles: Roles = DEFAULT_ROLES,
    validate: bool = True,
    multiline: bool = False,
    infer: bool = False,
) -> DataFrame:
    """Raw request CSV -> role-named DataFrame.

    ``schema`` (source header names) may be given; otherwise all columns are
    text.  ``multiline=True`` allows line breaks inside quoted fields, at the price of
    one task per file (such files cannot be split).  ``infer=True`` types the remaining text columns by
    :mod:`reqlens.sources.inference`, at the price of one pass over the input.  Numbers that do not parse
    become NULL and short records keep NULL fields; :func:`csv_report` counts
    both.  Raises ``FileNotFoundError`` for a missing path and ``ValueError``
    when a required role is absent.
    """
    if schema is None:
        df = _raw_text(spark, path, multiline).drop(CORRUPT)
    else:
        try:
            df = spark.read.options(**csv_options(multiline)).schema(schema).csv(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                raise FileNotFoundError(f"no CSV at {path}") from exc
            raise
    df = rename_to_roles(df, header_roles)
    df = _cast_numeric_roles(df, numeric_types if schema is None else {})
    df = cast_identifiers(df)
    if validate:
        validate_columns(df, roles)
    if infer and schema is None:
        df = infer_types(df)
    return df


def csv_report(
    spark: SparkSession,
    path: str,
    header_roles: Mapping[str, str] = SOURCE_HEADER_ROLES,
    numeric_types: Mapping[str, str] = RAW_NUMERIC_TYPES,
    multiline: bool = False,
) -> DataFrame:
    """``metric, value``: rows, columns, malformed records and, per numeric role, texts that are no number."""
    raw = rename_to_roles(_raw_text(spark, path, multiline, prune=False), {**header_roles, CORRUPT: CORRUPT})
    numeric = {c: t for c, t in numeric_types.items() if c in raw.columns}
    row = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(raw.columns) - 1).cast("long").alias("columns"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed_records"),
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"bad_{c}") for c, t in numeric.items()],
    )
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def validate_columns(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> bool:
    """Column contract: every required role present, else ``ValueError``."""
    missing = [c for c in roles.required if c not in df.columns]
    if missing:
        raise ValueError(f"table lacks required columns {missing}")
    return True


def contract_report(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """``required_column, present, filled_rows`` (rows with a value; 0 for an absent column)."""
    required = list(required)
    filled = [F.count(c) if c in df.columns else F.lit(0).cast("long") for c in required]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[f.alias(f"f{i}") for i, f in enumerate(filled)])
    lines = [
        F.struct(F.lit(c).alias("required_column"), F.lit(c in df.columns).alias("present"), F.col(f"f{i}").alias("filled_rows"))
        for i, c in enumerate(required)
    ]
    return row.select(F.inline(F.array(*lines)))


def ingest_report(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row DataFrame (one job when collected)."""
    return structure_profile(df)


def register_parquet_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Temp view over a Parquet table (absolute path), for ``spark.sql`` users."""
    df = read_parquet(spark, path)
    df.createOrReplaceTempView(name)
    return df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"no Parquet table at {path}") from exc
        raise


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] | None = None, mode: str = "overwrite") -> str:
    """Parquet sink with overwrite semantics; optional Hive-style partitioning.

    A partitioned write first brings each partition's rows together
    (``REBALANCE``: AQE splits large ones), so it makes a few files per
    partition instead of one per task and partition.
    """
    cols = list(partition_by or [])
    writer = (df.hint("rebalance", *cols) if cols else df).write.mode(mode)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return path


def write_gated(
    df: DataFrame,
    path: str,
    metrics: Iterable[Column],
    accept: Callable[[dict], dict],
    partition_by: Iterable[str] | None = None,
) -> dict:
    """Write ``df`` to ``path`` and pass its ``metrics``, observed by that write, to ``accept``: one read of the input.

    If ``accept`` raises, what was written must not be published: ``path`` should be part of a version
    that no release names yet (see :mod:`reqlens.sources.release`).
    """
    observed = Observation(f"gates-{uuid.uuid4().hex[:12]}")
    write_parquet(df.observe(observed, *metrics), path, partition_by)
    return accept(dict(observed.get))
