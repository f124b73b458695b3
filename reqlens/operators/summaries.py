"""Per-key summaries of the transformed table.

Each is one hash aggregate (partial per task, so a key holding a third of
all rows still sends one row per task to the shuffle) followed by a sort of
the small result.  Means are exact: integer hundredths summed, then rounded
HALF_UP once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqlens.functions.exact import from_hundredths, mean_hundredths, to_hundredths
from reqlens.roles import DEFAULT_ROLES, Roles

HOURS = "resolution_time_hours"


def resolved_count() -> Column:
    return F.count(HOURS)


def hours_sum_hundredths() -> Column:
    return F.sum(to_hundredths(F.col(HOURS)))


def mean_hours(sum_col: str = "_sum_h", n_col: str = "_n_h") -> Column:
    return from_hundredths(mean_hundredths(F.col(sum_col), F.col(n_col)))


def key_summary(df: DataFrame, key: str) -> DataFrame:
    """``key, request_count, avg_resolution_hours``; NULL key is a group; count desc."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            hours_sum_hundredths().alias("_sum_h"),
            resolved_count().alias("_n_h"),
        )
        .select(key, "request_count", mean_hours().alias("avg_resolution_hours"))
        .orderBy(F.desc("request_count"), F.asc_nulls_first(key))
    )


def category_summary(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return key_summary(df, roles.category)


def region_summary(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return key_summary(df, roles.region)


def handler_summary(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return key_summary(df, roles.handler)


def date_summary(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``request_date, request_count`` ascending by date."""
    return df.groupBy("request_date").agg(F.count(F.lit(1)).alias("request_count")).orderBy("request_date")


SUMMARY_KEYS = ("complaints_summary", "borough_summary", "agency_summary", "date_summary")


def summary_groups(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """All four summaries as one ``GROUPING SETS`` aggregate (one scan, one shuffle).

    Columns: the four keys, ``_g_<key>`` grouping flags (0 = grouped by that
    key), ``request_count``, ``_sum_h``, ``_n_h``.  The flags tell a NULL key
    value apart from a key that is not part of the set.  The result is small
    (one row per key value); :func:`split_summary_groups` turns it back into
    the four summaries.
    """
    keys = [roles.category, roles.region, roles.handler, "request_date"]
    return df.groupingSets([[k] for k in keys], *keys).agg(
        *[F.grouping(k).alias(f"_g_{k}") for k in keys],
        F.count(F.lit(1)).alias("request_count"),
        hours_sum_hundredths().alias("_sum_h"),
        resolved_count().alias("_n_h"),
    )


def split_summary_groups(groups: DataFrame, roles: Roles = DEFAULT_ROLES, ordered: bool = True) -> dict[str, DataFrame]:
    """The four summaries from :func:`summary_groups` output (same columns as the one-by-one forms).

    ``ordered=False`` skips the final sort (a sampling job and a range
    shuffle each): stored Parquet carries no row order for its readers.
    """

    def keyed(key: str) -> DataFrame:
        out = groups.where(F.col(f"_g_{key}") == 0).select(
            key, "request_count", mean_hours().alias("avg_resolution_hours")
        )
        return out.orderBy(F.desc("request_count"), F.asc_nulls_first(key)) if ordered else out

    dates = groups.where(F.col("_g_request_date") == 0).select("request_date", "request_count")
    return {
        "complaints_summary": keyed(roles.category),
        "borough_summary": keyed(roles.region),
        "agency_summary": keyed(roles.handler),
        "date_summary": dates.orderBy("request_date") if ordered else dates,
    }
