"""Sources, sinks and the column contract."""

from reqlens.sources.files import (
    contract_report,
    csv_report,
    read_raw_csv,
    read_parquet,
    register_parquet_view,
    rename_to_roles,
    validate_columns,
    write_gated,
    write_parquet,
    ingest_report,
    cast_identifiers,
)
from reqlens.sources.inference import infer_types, inferred_schema
from reqlens.sources.quarantine import Rules, good_records, quarantined_records, split_raw_csv
from reqlens.sources.release import Release, current_release, expired, publish_release, release_log
from reqlens.sources.testdata import raw_requests, load_table

__all__ = [
    "Release",
    "Rules",
    "cast_identifiers",
    "contract_report",
    "csv_report",
    "current_release",
    "expired",
    "good_records",
    "infer_types",
    "inferred_schema",
    "ingest_report",
    "load_table",
    "publish_release",
    "quarantined_records",
    "raw_requests",
    "read_parquet",
    "read_raw_csv",
    "register_parquet_view",
    "release_log",
    "rename_to_roles",
    "split_raw_csv",
    "validate_columns",
    "write_gated",
    "write_parquet",
]
