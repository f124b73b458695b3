"""Derived calendar and resolution-time features (narrow projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqlens.functions.dates import whole_seconds_between
from reqlens.functions.exact import from_hundredths, hours_hundredths
from reqlens.roles import DEFAULT_ROLES, Roles


def add_date_features(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``request_date/year/month/day_of_week/hour`` from the created time (NULL in, NULL out)."""
    created = F.col(roles.created)
    return df.withColumns(
        {
            "request_date": F.to_date(created),
            "request_year": F.year(created),
            "request_month": F.month(created),
            "request_day_of_week": F.date_format(created, "EEEE"),
            "request_hour": F.hour(created),
        }
    )


def add_resolution_time(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``resolution_time_hours``: only for Closed requests with a closed time in valid order.

    Whole seconds between created and closed, in hours rounded HALF_UP to two
    places (computed on integers, so 18 s -> 0.01 exactly).
    """
    eligible = (
        (F.col(roles.status) == roles.closed_status)
        & F.col(roles.closed).isNotNull()
        & ~F.col(roles.invalid_flag)
    )
    seconds = whole_seconds_between(F.col(roles.created), F.col(roles.closed))
    return df.withColumn("resolution_time_hours", F.when(eligible, from_hundredths(hours_hundredths(seconds))))


def transform_requests(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Cleaned -> transformed (both feature groups, lazy)."""
    return df.transform(add_date_features, roles=roles).transform(add_resolution_time, roles=roles)
