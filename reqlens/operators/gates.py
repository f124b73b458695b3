"""Validation gates.

The source pipeline ran one counting job per rule (ten passes over the
input for cleaning alone).  Here each stage's rules are fused into **one
aggregate**: a single scan that reads only the columns the rules touch,
partial aggregation per task, one row to the driver.  ``*_metrics`` return
that row as a DataFrame; ``check_*`` collect it and raise ``ValueError``.

Gates are null-safe, so stricter than plain comparisons: a flag that is
true while a date is NULL, or a NULL status carrying a resolution time,
is caught rather than slipping through three-valued logic.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqlens.roles import CATEGORY_SPELLING, DEFAULT_ROLES, DERIVED_FEATURE_COLUMNS, MISSING_TOKEN, Roles, present


def cleaning_metric_columns(
    df: DataFrame,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    placeholder_columns: Iterable[str] | None = None,
    token: str = MISSING_TOKEN,
    roles: Roles = DEFAULT_ROLES,
) -> list[Column]:
    """The cleaning gates as aggregate columns (for ``agg`` or ``observe``)."""
    expected = F.coalesce(F.col(roles.created) > F.col(roles.closed), F.lit(False))
    cols = present(df.columns, placeholder_columns if placeholder_columns is not None else roles.cleaned_placeholders)
    leftovers = [F.count_if(F.col(c) == token) for c in cols]
    remaining = sum(leftovers[1:], leftovers[0]) if leftovers else F.lit(0).cast("long")
    bad_spelling = (
        F.count_if(F.col(roles.category).isin(list(spelling))) if spelling else F.lit(0).cast("long")
    )
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col(roles.invalid_flag).eqNullSafe(expected)).alias("flag_mismatch_rows"),
        remaining.alias("remaining_placeholders"),
        bad_spelling.alias("unstandardized_categories"),
    ]


def cleaning_metrics(
    df: DataFrame,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    placeholder_columns: Iterable[str] | None = None,
    token: str = MISSING_TOKEN,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """One row: ``row_count``, ``flag_mismatch_rows``, ``remaining_placeholders``, ``unstandardized_categories``."""
    return df.agg(*cleaning_metric_columns(df, spelling, placeholder_columns, token, roles))


def transform_metric_columns(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> list[Column]:
    """The transform gates as aggregate columns (for ``agg`` or ``observe``)."""
    hours = F.col("resolution_time_hours")
    has = hours.isNotNull()
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(roles.invalid_flag) & has).alias("flagged_with_resolution"),
        F.count_if(F.col(roles.closed).isNull() & has).alias("unresolved_with_resolution"),
        F.count_if(~F.col(roles.status).eqNullSafe(roles.closed_status) & has).alias("non_closed_with_resolution"),
        F.count_if(hours < 0).alias("negative_resolution"),
    ]


def transform_metrics(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row: row count plus four resolution-time invariants (all should be 0)."""
    return df.agg(*transform_metric_columns(df, roles))


def _raise_on(metrics: dict, gates: Iterable[str]) -> None:
    broken = {g: metrics[g] for g in gates if metrics.get(g)}
    if broken:
        raise ValueError(f"gate failed: {broken}")


#: Metrics that must be zero.
CLEANING_GATES = ("flag_mismatch_rows", "remaining_placeholders", "unstandardized_categories")
TRANSFORM_GATES = ("flagged_with_resolution", "unresolved_with_resolution", "non_closed_with_resolution", "negative_resolution")


def evaluate_cleaning(metrics: dict) -> dict:
    """Raise ``ValueError`` if cleaning metrics (from ``agg`` or an ``Observation``) show a violation."""
    _raise_on(metrics, CLEANING_GATES)
    return metrics


def evaluate_transform(metrics: dict, expected_row_count: int | None = None) -> dict:
    """Raise ``ValueError`` if transform metrics show a violation or a changed row count."""
    if expected_row_count is not None and metrics["row_count"] != expected_row_count:
        raise ValueError(
            f"gate failed: {metrics['row_count']} rows after the transform, {expected_row_count} before"
        )
    _raise_on(metrics, TRANSFORM_GATES)
    return metrics


def check_cleaning(df: DataFrame, spelling: Mapping[str, str] = CATEGORY_SPELLING, roles: Roles = DEFAULT_ROLES) -> dict:
    """Run the fused cleaning gates (one job); raise ``ValueError`` on any violation."""
    return evaluate_cleaning(cleaning_metrics(df, spelling=spelling, roles=roles).first().asDict())


def require_feature_columns(df: DataFrame) -> None:
    """Column contract of the transformed table (``ValueError`` when a derived column is missing)."""
    missing = [c for c in DERIVED_FEATURE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"table lacks derived columns {missing}")


def check_transform(df: DataFrame, expected_row_count: int | None = None, roles: Roles = DEFAULT_ROLES) -> dict:
    """Column contract, then the fused transform gates (one job); raise ``ValueError``."""
    require_feature_columns(df)
    return evaluate_transform(transform_metrics(df, roles=roles).first().asDict(), expected_row_count)
