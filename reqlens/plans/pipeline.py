"""End-to-end batch pipeline: raw -> cleaned -> transformed -> summaries.

Stage boundaries are Parquet tables of a new version under one output directory;
each stage reads the previous stage back, so lineage is cut at every boundary and
a lost executor only ever recomputes from the last written table.  Gates are
observed by each write.  Once all have passed, one manifest publishes the layers
and their summaries together (:mod:`reqlens.sources.release`): whenever a run fails
or is killed, readers keep the last release whole.  The output directory must be on
shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from reqlens.operators import quality as Q
from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.operators.gates import (
    cleaning_metric_columns,
    evaluate_cleaning,
    evaluate_transform,
    require_feature_columns,
    transform_metric_columns,
)
from reqlens.operators.summaries import split_summary_groups, summary_groups
from reqlens.plans.analyses import run_analyses
from reqlens.plans.profile import fused_profile
from reqlens.roles import CATEGORY_SPELLING, DEFAULT_ROLES, Roles
from reqlens.sources.files import write_gated, write_parquet
from reqlens.sources.release import Release, current_release, new_version, publish_release


@dataclass
class PipelineResult:
    cleaned_path: str
    transformed_path: str
    summary_paths: dict[str, str]
    cleaning_metrics: dict
    transform_metrics: dict
    release: Release | None = None
    analyses: dict[str, DataFrame] = field(default_factory=dict)


def clean_stage(
    raw: DataFrame,
    out_path: str,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    roles: Roles = DEFAULT_ROLES,
) -> dict:
    """Clean, write, gate.  Returns the gate metrics.

    The gates are observed by the write job, so the raw input is read once;
    if one fails, ``ValueError`` is raised and ``out_path`` must not be published.
    """
    cleaned = clean_requests(raw, spelling=spelling, roles=roles)
    return write_gated(cleaned, out_path, cleaning_metric_columns(cleaned, spelling, roles=roles), evaluate_cleaning)


def transform_stage(
    spark: SparkSession,
    cleaned_path: str,
    out_path: str,
    expected_rows: int | None,
    roles: Roles = DEFAULT_ROLES,
    partition_by: Sequence[str] = (),
) -> dict:
    """Read cleaned, derive features, write, gate (as :func:`clean_stage`).

    ``partition_by`` (e.g. ``("request_year", "request_month")``) writes a
    Hive-partitioned layer, so readers that slice by date prune whole
    directories; rows are redistributed by it first, which bounds the files.
    """
    transformed = transform_requests(spark.read.parquet(cleaned_path), roles=roles)
    require_feature_columns(transformed)
    return write_gated(
        transformed,
        out_path,
        transform_metric_columns(transformed, roles),
        lambda metrics: evaluate_transform(metrics, expected_rows),
        partition_by,
    )


def summary_stage(spark: SparkSession, transformed_path: str, out_dir: str, roles: Roles = DEFAULT_ROLES) -> dict[str, str]:
    """Write the four summaries.

    One ``GROUPING SETS`` aggregate over the transformed table (a single scan
    instead of four) is persisted (one row per key value, so small), and each
    summary is cut from it and written unsorted (stored Parquet has no row
    order for readers).  A lost executor only costs recomputing that one
    aggregate from the written transformed table.
    """
    groups = summary_groups(spark.read.parquet(transformed_path), roles).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paths = {}
        for name, summary in split_summary_groups(groups, roles, ordered=False).items():
            paths[name] = write_parquet(summary, f"{out_dir}/{name}")
    finally:
        groups.unpersist()
    return paths


PROFILE_CHECKS = {
    "structure_profile": Q.structure_profile,
    "date_range": Q.date_range,
    "unparseable_dates": Q.unparseable_dates,
    "missing_profile": Q.missing_profile,
    "core_completeness": Q.core_completeness,
    "placeholder_counts": Q.placeholder_counts,
    "placeholder_totals": Q.placeholder_totals,
    "full_row_duplicates": Q.full_row_duplicates,
    "duplicate_keys": Q.duplicate_keys,
    "status_counts": Q.status_counts,
    "missing_closed_by_status": Q.missing_closed_by_status,
    "closed_missing_closed_date": Q.closed_missing_closed_date,
    "non_closed_with_closed_date": Q.non_closed_with_closed_date,
    "non_closed_closed_by_status": Q.non_closed_closed_by_status,
    "invalid_date_rows": Q.invalid_date_rows,
    "invalid_date_by_status": Q.invalid_date_by_status,
    "invalid_date_matching_resolution": Q.invalid_date_matching_resolution,
    "invalid_date_details": Q.invalid_date_details,
    "borough_counts": Q.region_counts,
    "missing_zip_count": Q.missing_zip_count,
    "missing_zip_by_borough": Q.missing_zip_by_region,
    "unspecified_borough_rows": Q.unspecified_region_rows,
    "missing_coords_by_borough": Q.missing_coords_by_region,
    "missing_coord_rows": Q.missing_coord_rows,
    "coord_mismatch_rows": Q.coord_mismatch_rows,
    "distinct_complaints": Q.distinct_categories,
    "complaint_ranking": Q.category_ranking,
    "blank_complaints": Q.blank_categories,
    "distinct_agencies": Q.distinct_handlers,
    "agency_ranking": Q.handler_ranking,
    "blank_agencies": Q.blank_handlers,
    "agency_name_consistency": Q.handler_name_consistency,
    "complaint_case_variants": Q.category_case_variants,
    "quality_counts": Q.quality_counts,
}


def profile_stage(spark: SparkSession, raw: DataFrame, out_dir: str, roles: Roles = DEFAULT_ROLES) -> dict[str, DataFrame]:
    """The whole quality profile over one columnar copy of the raw table.

    The raw source (typically CSV) is parsed once and written as Parquet under
    ``out_dir/raw``; three scans of that copy give the parts that all checks are
    made from (:mod:`reqlens.plans.profile`).  Returns lazy DataFrames, one per
    check, over those parts.  Row duplicates are counted from the rows themselves.
    """
    out_dir = out_dir.rstrip("/")
    staged = spark.read.parquet(write_parquet(raw, f"{out_dir}/raw"))
    found = fused_profile(spark, staged, f"{out_dir}/parts", roles)
    return {**{name: found[name] for name in PROFILE_CHECKS}, "full_row_duplicates": Q.full_row_duplicates(staged, roles)}


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    roles: Roles = DEFAULT_ROLES,
    with_analyses: bool = True,
    partition_transformed_by: Sequence[str] = (),
) -> PipelineResult:
    """Raw request table -> Parquet layers + summaries in one release (+ lazy analyses over the written table)."""
    out_dir = out_dir.rstrip("/")
    version = new_version(out_dir)
    at = f"{out_dir}/{version}"
    clean_metrics = clean_stage(raw, f"{at}/cleaned", spelling, roles)
    transform_metrics = transform_stage(
        spark, f"{at}/cleaned", f"{at}/transformed", clean_metrics["row_count"], roles, partition_transformed_by
    )
    summary_paths = summary_stage(spark, f"{at}/transformed", at, roles)
    tables = {name: f"{version}/{name}" for name in ("cleaned", "transformed", *summary_paths)}
    release = publish_release(spark, out_dir, version, tables)
    analyses = run_analyses(release.read(spark, "transformed"), roles=roles) if with_analyses else {}
    return PipelineResult(
        f"{at}/cleaned", f"{at}/transformed", summary_paths, clean_metrics, transform_metrics, release, analyses
    )


def publish_cleaned(spark: SparkSession, raw: DataFrame, out_dir: str, roles: Roles = DEFAULT_ROLES) -> tuple[Release, dict]:
    """The cleaned layer alone as a new release; other tables stay those of the last one."""
    out_dir = out_dir.rstrip("/")
    version = new_version(out_dir)
    metrics = clean_stage(raw, f"{out_dir}/{version}/cleaned", roles=roles)
    last = current_release(spark, out_dir)
    return publish_release(spark, out_dir, version, {"cleaned": f"{version}/cleaned"}, keep=last), metrics


def publish_transformed(spark: SparkSession, out_dir: str, roles: Roles = DEFAULT_ROLES) -> tuple[Release, dict]:
    """Transformed layer and all summaries, from the current release's cleaned layer, as a new release."""
    out_dir = out_dir.rstrip("/")
    last = current_release(spark, out_dir)
    if last is None:
        raise FileNotFoundError(f"no release under {out_dir}")
    version = new_version(out_dir)
    at = f"{out_dir}/{version}"
    expected = last.read(spark, "cleaned").count()  # Parquet footers: no column is read
    metrics = transform_stage(spark, last.path("cleaned"), f"{at}/transformed", expected, roles)
    names = ("transformed", *summary_stage(spark, f"{at}/transformed", at, roles))
    return publish_release(spark, out_dir, version, {n: f"{version}/{n}" for n in names}, keep=last), metrics
