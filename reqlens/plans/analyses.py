"""The nine analyses (plus row count and a sample) over the transformed table.

Plan shape, chosen for scale:

* Every analysis scans the table **once**.  Work after the first aggregate
  runs on aggregated rows (categories x regions, hours, dates), whose number
  is bounded by the category domains, not by the data.  E.g. the top-10
  category list is derived from the ``(category, hour)`` aggregate instead of
  a second scan, and the first/last date bounds from the daily aggregate.
* Partial (map-side) aggregation means a category holding a third of all rows
  still contributes one row per task to the shuffle.
* Windows without a partition key (ranks of hours and days, ``sum() over ()``) only ever
  see aggregated rows, of bounded domains; handlers are ranked without one.
* Means, shares and percentage differences use exact integer arithmetic
  (:mod:`reqlens.functions.exact`), so results do not depend on partitioning.

Semantics kept from the source queries: ``RANK`` keeps ties (top-k may give
more than k rows), the ``Unspecified`` / NULL region is excluded where it was
(``<>`` drops NULL too), the weekday pattern drops the first and last dates,
the daily average is rounded before comparing, and the HAVING threshold is
applied before ranking.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqlens.functions.dates import hour_label
from reqlens.functions.exact import from_hundredths, half_up_div, mean_hundredths, ratio_2dp, share_pct, signed_pct_change
from reqlens.operators.ranking import value_ranks
from reqlens.operators.summaries import hours_sum_hundredths, mean_hours, resolved_count
from reqlens.roles import DEFAULT_ROLES, WEEK_ORDER, WEEKEND_DAYS, Roles


def _all_rows() -> Window:
    """A window over all rows; only ever applied to aggregated rows."""
    return Window.partitionBy()


def _n() -> Column:
    return F.count(F.lit(1))


def _specified(df: DataFrame, roles: Roles) -> DataFrame:
    # ``<>`` on purpose: a NULL region is dropped as well.
    return df.where(F.col(roles.region) != roles.unspecified_region)


def total_rows(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.agg(_n().alias("total_rows"))


def sample_features(df: DataFrame, n: int = 5, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The derived columns of the ``n`` lowest keys (a top-k, not a full sort)."""
    cols = [roles.key, "request_date", "request_day_of_week", "request_hour", "resolution_time_hours"]
    return df.select(*cols).orderBy(*[F.asc_nulls_last(c) for c in cols]).limit(n)


def top_categories_by_region(df: DataFrame, top_n: int = 3, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Top ``top_n`` categories per region with their share of the region's requests."""
    region, cat = roles.region, roles.category
    counts = _specified(df, roles).groupBy(region, cat).agg(_n().alias("num_complaints"))
    by_region = Window.partitionBy(region)
    ranked = counts.select(
        region,
        cat,
        "num_complaints",
        F.sum("num_complaints").over(by_region).alias("_region_total"),
        F.rank().over(by_region.orderBy(F.desc("num_complaints"))).alias("complaint_rank"),
    )
    return (
        ranked.where(F.col("complaint_rank") <= top_n)
        .select(
            region,
            cat,
            "num_complaints",
            "complaint_rank",
            share_pct(F.col("num_complaints"), F.col("_region_total")).alias("complaint_share_percentage"),
        )
        .orderBy(region, "complaint_rank", F.asc_nulls_first(cat))
    )


def _resolution_agg(df: DataFrame, keys: Iterable[str], total: str, resolved: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        _n().alias(total),
        resolved_count().alias(resolved),
        hours_sum_hundredths().alias("_sum_h"),
    )


def high_volume_categories(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Categories with strictly more requests than the mean per category, slowest first."""
    cat = roles.category
    per = _resolution_agg(df, [cat], "total_request_count", "resolved_request_count")
    # one row, so broadcast: the categories themselves stay distributed
    totals = per.agg(_n().alias("_categories"), F.sum("total_request_count").alias("_all"))
    # total > avg(total)  <=>  total * categories > sum(total)  (exact)
    return (
        per.join(F.broadcast(totals), F.col("total_request_count") * F.col("_categories") > F.col("_all"))
        .select(
            cat,
            "total_request_count",
            "resolved_request_count",
            mean_hours("_sum_h", "resolved_request_count").alias("average_resolution_time_hours"),
        )
        .orderBy(F.desc_nulls_last("average_resolution_time_hours"), F.asc_nulls_first(cat))
    )


def handler_workload_speed(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Workload rank (requests desc) against speed rank (rounded mean hours asc), both without a task that holds all handlers."""
    handler = roles.handler
    per = _resolution_agg(df, [handler], "total_requests", "resolved_requests").select(
        handler, "total_requests", "resolved_requests", mean_hundredths(F.col("_sum_h"), F.col("resolved_requests")).alias("_mean")
    )
    ranks = value_ranks(per, {"total_requests": True, "_mean": False})
    of = lambda c, name: ranks.where(F.col("column") == c).select(F.col("value").alias(c), F.col("rank").alias(name))
    workload, speed = of("total_requests", "workload_rank"), of("_mean", "speed_rank")
    return per.join(workload, "total_requests").join(speed, "_mean", "left").select(
        handler, "total_requests", "resolved_requests", from_hundredths(F.col("_mean")).alias("avg_resolution_hours"),
        "workload_rank", "speed_rank",
    ).orderBy("workload_rank", F.asc_nulls_first(handler))


def region_coverage(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Per region: requests, resolved, mean hours and resolved share of all its requests."""
    region = roles.region
    per = _resolution_agg(_specified(df, roles), [region], "total_request_count", "resolved_request_count")
    return per.select(
        region,
        "total_request_count",
        "resolved_request_count",
        mean_hours("_sum_h", "resolved_request_count").alias("avg_resolution_time_hours"),
        share_pct(F.col("resolved_request_count"), F.col("total_request_count")).alias(
            "resolution_coverage_percentage"
        ),
    ).orderBy(F.desc_nulls_last("avg_resolution_time_hours"), F.asc_nulls_first(region))


def peak_hours(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Requests per hour of day (hours present only), dense rank and share."""
    hourly = df.groupBy("request_hour").agg(_n().alias("hourly_request_count"))
    return hourly.select(
        hour_label(F.col("request_hour")).alias("request_hour"),
        "hourly_request_count",
        F.dense_rank().over(_all_rows().orderBy(F.desc("hourly_request_count"))).alias("request_hour_rank"),
        share_pct(F.col("hourly_request_count"), F.sum("hourly_request_count").over(_all_rows())).alias(
            "hour_share_percentage"
        ),
        F.col("request_hour").alias("_h"),
    ).orderBy(F.asc_nulls_first("_h")).drop("_h")


def weekday_pattern(
    df: DataFrame, weekend: Iterable[str] = WEEKEND_DAYS, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Average requests per day and mean hours by day of week, first and last dates excluded.

    Mean hours is the mean of each day's rounded mean (days weigh equally);
    the rank uses the unrounded requests-per-day average.
    """
    daily = df.groupBy("request_date", "request_day_of_week").agg(
        _n().alias("daily_request_count"), hours_sum_hundredths().alias("_sum_h"), resolved_count().alias("_n_h")
    )
    inner = daily.select(
        "*",
        F.min("request_date").over(_all_rows()).alias("_first"),
        F.max("request_date").over(_all_rows()).alias("_last"),
    ).where((F.col("request_date") > F.col("_first")) & (F.col("request_date") < F.col("_last")))
    inner = inner.withColumn("_day_mean", half_up_div(F.col("_sum_h"), F.col("_n_h")))
    weekly = inner.groupBy("request_day_of_week").agg(
        _n().alias("_days"),
        F.sum("daily_request_count").alias("_requests"),
        F.sum("_day_mean").alias("_sum_means"),
        F.count("_day_mean").alias("_n_means"),
    )
    order = F.create_map(*[F.lit(x) for i, d in enumerate(WEEK_ORDER) for x in (d, i + 1)])
    per_day = F.col("_requests") / F.col("_days")
    return weekly.select(
        "request_day_of_week",
        F.when(F.col("request_day_of_week").isin(list(weekend)), "Weekend").otherwise("Weekday").alias("day_type"),
        ratio_2dp(F.col("_requests"), F.col("_days")).alias("average_requests_per_day"),
        from_hundredths(half_up_div(F.col("_sum_means"), F.col("_n_means"))).alias("average_resolution_hours"),
        F.rank().over(_all_rows().orderBy(per_day.desc())).alias("day_rank"),
        F.try_element_at(order, F.col("request_day_of_week")).alias("_order"),
    ).orderBy(F.asc_nulls_last("_order")).drop("_order")


def daily_spikes(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Each date's requests against the (rounded) average day: % difference and status."""
    daily = df.groupBy("request_date").agg(_n().alias("daily_request_count"))
    avg_h = half_up_div(F.sum("daily_request_count").over(_all_rows()) * 100, _n().over(_all_rows()))
    with_avg = daily.withColumn("_avg_h", avg_h)
    scaled = F.col("daily_request_count") * 100
    return with_avg.select(
        "request_date",
        "daily_request_count",
        from_hundredths(F.col("_avg_h")).alias("avg_daily_requests"),
        signed_pct_change(F.col("daily_request_count"), F.col("_avg_h")).alias("percentage_difference"),
        F.when(scaled > F.col("_avg_h"), "Above Average")
        .when(scaled < F.col("_avg_h"), "Below Average")
        .otherwise("Average")
        .alias("comparison_status"),
    ).orderBy(F.asc_nulls_first("request_date"))


def _top_groups(fine: DataFrame, group: str, count_col: str, top_n: int) -> DataFrame:
    """The rows of ``fine`` whose ``group`` RANKs (by total ``count_col``, ties kept) within ``top_n``.

    ``fine`` has a few rows per group (one per hour or region).  Each group is
    folded into one row with its total and its rows as an array, and a plain
    ``rank() <= top_n`` follows: Spark trims every task to its own top groups
    before the single exchange, so the one task that ranks sees ``top_n``
    groups (and ties) per task, not all of them.
    """
    rest = [c for c in fine.columns if c != group]
    folded = fine.groupBy(group).agg(F.sum(count_col).alias("_group_total"), F.collect_list(F.struct(*rest)).alias("_rows"))
    ranked = folded.withColumn("_rank", F.rank().over(_all_rows().orderBy(F.desc("_group_total"))))
    return ranked.where(F.col("_rank") <= top_n).select(group, F.inline("_rows"))


def peak_hour_by_category(df: DataFrame, top_n: int = 10, top_hours: int = 3, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """For the ``top_n`` commonest categories, their ``top_hours`` busiest hours (dense rank, ties kept).

    The top list ranks every category, NULL included (it can take a slot);
    a NULL category is then never reported, as an equi join would drop it.
    """
    cat = roles.category
    by_hour = df.groupBy(cat, "request_hour").agg(_n().alias("hourly_request_count"))
    top = _top_groups(by_hour, cat, "hourly_request_count", top_n).where(F.col(cat).isNotNull())
    ranked = top.withColumn(
        "hour_rank", F.dense_rank().over(Window.partitionBy(cat).orderBy(F.desc("hourly_request_count")))
    )
    return (
        ranked.where(F.col("hour_rank") <= top_hours)
        .select(cat, hour_label(F.col("request_hour")).alias("request_hour"), "hourly_request_count", "hour_rank",
                F.col("request_hour").alias("_h"))
        .orderBy(cat, "hour_rank", F.asc_nulls_first("_h"))
        .drop("_h")
    )


def category_resolution_by_region(
    df: DataFrame, top_n: int = 10, min_resolved: int = 100, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Mean hours of the top categories per region, ranked within each category (slowest first).

    The top list counts all rows (every region); regions are filtered
    afterwards; groups with fewer than ``min_resolved`` resolved requests are
    dropped before ranking, so ranks are among the survivors.
    """
    cat, region = roles.category, roles.region
    per = _resolution_agg(df, [cat, region], "_total", "resolved_requests")
    kept = _top_groups(per, cat, "_total", top_n).where(
        F.col(cat).isNotNull()
        & (F.col(region) != roles.unspecified_region)
        & (F.col("resolved_requests") >= min_resolved)
    )
    mean_exact = F.col("_sum_h") / F.col("resolved_requests")
    return (
        kept.select(
            cat,
            region,
            "resolved_requests",
            mean_hours("_sum_h", "resolved_requests").alias("avg_resolution_hours"),
            F.dense_rank().over(Window.partitionBy(cat).orderBy(mean_exact.desc())).alias("resolution_rank"),
        )
        .orderBy(cat, "resolution_rank", F.asc_nulls_first(region))
    )


# Registry of named analyses (name -> DataFrame -> DataFrame), in report order.
ANALYSES = {
    "top_complaints_by_borough": top_categories_by_region,
    "high_volume_complaints": high_volume_categories,
    "agency_workload_speed": handler_workload_speed,
    "borough_coverage": region_coverage,
    "peak_hours": peak_hours,
    "weekday_pattern": weekday_pattern,
    "daily_spikes": daily_spikes,
    "peak_hour_by_complaint": peak_hour_by_category,
    "complaint_resolution_by_borough": category_resolution_by_region,
}


def run_analyses(
    df: DataFrame, names: Iterable[str] | None = None, roles: Roles = DEFAULT_ROLES
) -> dict[str, DataFrame]:
    """Named analyses as lazy DataFrames (nothing runs until an action)."""
    chosen = list(names) if names is not None else list(ANALYSES)
    return {name: ANALYSES[name](df, roles=roles) for name in chosen}
