"""Cleaning rules (each ``DataFrame -> DataFrame``, chainable with ``df.transform``).

All rules are per-row projections, so the whole cleaning stage is one
narrow, codegen'd ``Project`` over the scan: no shuffle, no extra pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqlens.functions.dates import parse_timestamp
from reqlens.roles import CATEGORY_SPELLING, DEFAULT_ROLES, MISSING_TOKEN, RAW_DATE_PATTERN, Roles, present


def parse_timestamps(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    pattern: str = RAW_DATE_PATTERN,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Text date columns -> ``timestamp_ntz``; unparseable text -> NULL.

    Zoned timestamps are converted to ``timestamp_ntz`` too, so the cleaned
    table has one timestamp type whatever the source.
    """
    types = dict(df.dtypes)
    cols = present(df.columns, columns if columns is not None else roles.date_columns)
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
    exprs = {}
    for c in cols:
        if types[c] == "string":
            exprs[c] = parse_timestamp(F.col(c), pattern, zone)
        elif types[c] == "timestamp":
            exprs[c] = F.col(c).cast(T.TimestampNTZType())
    return df.withColumns(exprs) if exprs else df


def normalize_placeholders(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    token: str = MISSING_TOKEN,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Exact ``token`` -> NULL in the placeholder columns (other tokens are kept)."""
    cols = present(df.columns, columns if columns is not None else roles.cleaned_placeholders)
    return df.withColumns({c: F.nullif(F.col(c), F.lit(token)) for c in cols}) if cols else df


def flag_invalid_dates(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``invalid_date_order``: created after closed; never NULL (a NULL date -> false)."""
    cond = F.col(roles.created) > F.col(roles.closed)
    return df.withColumn(roles.invalid_flag, F.coalesce(cond, F.lit(False)))


def standardize_categories(
    df: DataFrame,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Replace known misspellings of the category by their standard form; others untouched."""
    if not spelling or roles.category not in df.columns:
        return df
    lookup = F.create_map(*[F.lit(x) for kv in spelling.items() for x in kv])
    c = F.col(roles.category)
    return df.withColumn(roles.category, F.coalesce(F.try_element_at(lookup, c), c))


def clean_requests(
    df: DataFrame,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    pattern: str = RAW_DATE_PATTERN,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Raw -> cleaned: parse dates, placeholders to NULL, flag, spelling (lazy)."""
    return (
        df.transform(parse_timestamps, pattern=pattern, roles=roles)
        .transform(normalize_placeholders, roles=roles)
        .transform(flag_invalid_dates, roles=roles)
        .transform(standardize_categories, spelling=spelling, roles=roles)
    )
