"""

``entry(spark)`` runs the flagship analysis on sf0.001; ``queries()`` maps
every implemented operator to a ``(spark, sf_dir) -> DataFrame`` callable;
``oracle_sql()`` gives the DuckDB SQL twin of each (see ``reqlens.oracle``).

Every query starts from the whole test tables: the request table is derived
from ``events ⋈ customer ⋈ nation ⋈ region`` (``reqlens.sources.testdata``),
then cleaned and transformed exactly as the pipeline does.
"""

from __future__ import annotations

import functools
import os
import sys
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # loaded by file path: make the package importable
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.operators import clean as C
from reqlens.operators import gates as G
from reqlens.operators import quality as Q
from reqlens.operators import summaries as S
from reqlens.operators.spelling import apply_spelling, spelling_map, spelling_review
from reqlens.operators.features import add_date_features, transform_requests
from reqlens.plans import analyses as A
from reqlens.plans.pipeline import PROFILE_CHECKS, run_pipeline
from reqlens.plans.profile import Layout
from reqlens.plans.sql_script import ANALYSES_SQL, run_script
from reqlens.roles import CLEANED_PLACEHOLDER_COLUMNS, DEFAULT_ROLES, DERIVED_FEATURE_COLUMNS, IDENTIFIER_COLUMNS
from reqlens.session import shared_folder
from reqlens.sources.files import cast_identifiers, contract_report, csv_report, read_raw_csv, register_parquet_view
from reqlens.sources.inference import inferred_schema
from reqlens.sources.order_lines import LINE_ROLES, LINE_SPELLING, raw_lines
from reqlens.sources.quarantine import good_records, quarantine_summary, quarantined_records, split_raw_csv
from reqlens.sources.release import current_release
from reqlens.sources.testdata import (
    CATEGORY_SPELLING,
    faulty_csv_copy,
    raw_csv_copy,
    raw_requests,
    ungated_cleaned,
    ungated_transformed,
)
from reqlens.streaming.partials import add_profile_batch, add_summary_batch, profile_store, stored_profile, stored_summaries, summary_store

try:  # the corpus operators are an optional part
    import corpus_pipeline
    from reqlens.llm.queries import ORACLE as CORPUS_ORACLE
    from reqlens.llm.queries import QUERIES as CORPUS_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "reqlens.llm", "reqlens.llm.queries"):
        raise
    CORPUS_QUERIES, CORPUS_ORACLE = {}, {}
else:
    CORPUS_QUERIES = {**CORPUS_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        CORPUS_ORACLE = {**CORPUS_ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}

SF_SMOKE = "/root/testdata/sf0.001"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_requests(spark, sf_dir)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_requests(_raw(spark, sf_dir), spelling=CATEGORY_SPELLING)


def _transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_requests(_cleaned(spark, sf_dir))


def _on_raw(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_raw(spark, sf_dir))


def _on_cleaned(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_cleaned(spark, sf_dir))


def _on_transformed(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_transformed(spark, sf_dir))


def _sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_parquet_view(spark, f"{sf_dir.rstrip('/')}/events.parquet", "reqlens_events")
    return spark.sql("SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM reqlens_events GROUP BY event_type")


def _csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_csv(spark, raw_csv_copy(spark, sf_dir), numeric_types={})


def _cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_requests(raw_lines(spark, sf_dir), spelling=LINE_SPELLING, roles=LINE_ROLES)


def _transformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_requests(_cleaned_lines(spark, sf_dir), roles=LINE_ROLES)


def _on_lines(fn, source: Callable[[SparkSession, str], DataFrame] = _transformed_lines) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(source(spark, sf_dir), roles=LINE_ROLES)


def _split_csv(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    out = f"{shared_folder(spark)}/split-{uuid.uuid4().hex}"
    split_raw_csv(spark, faulty_csv_copy(spark, sf_dir), out)
    if part == "good":
        return good_records(spark, out)
    bad = quarantined_records(spark, out)
    if part == "summary":  # all files are one here: how many there are depends on the machine
        return quarantine_summary(bad.withColumn("source_file", F.lit("export")))
    return (
        good_records(spark, out)
        .select("unique_key", F.lit(True).alias("accepted"), F.lit("").alias("reasons"))
        .unionByName(bad.select("unique_key", F.lit(False).alias("accepted"), F.array_join("reasons", ",").alias("reasons")))
    )


def _published_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table of a release that the whole pipeline publishes."""
    out = f"{shared_folder(spark)}/release-{uuid.uuid4().hex}"
    run_pipeline(spark, _raw(spark, sf_dir), out, spelling=CATEGORY_SPELLING, with_analyses=False)
    release = current_release(spark, out)
    counts = [release.read(spark, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for t in release.tables]
    return functools.reduce(DataFrame.unionByName, counts)


def _reviewed_gates(raw: DataFrame) -> DataFrame:
    """Cleaning by the derived spelling map, held to the same map by its gate."""
    spelling = spelling_map(spelling_review(raw))
    return G.cleaning_metrics(C.clean_requests(raw, spelling=spelling), spelling=spelling)


ARRIVING = (
    "date_range", "missing_profile", "placeholder_counts", "status_counts", "full_row_duplicates", "duplicate_keys", "quality_counts",
    "invalid_date_rows", "complaint_case_variants",
)
MAINTAINED = ("complaints_summary", "borough_summary", "agency_summary", "date_summary")


def _batches(df: DataFrame) -> list[tuple[int, DataFrame]]:
    """Four batches out of order, one of them replayed."""
    dealt = [df.where(F.pmod(F.xxhash64("unique_key", "detail"), F.lit(4)) == k) for k in range(4)]
    return [(k, dealt[k]) for k in (3, 0, 2, 0, 1)]


#: Stores that several keys read, by application, kind and tables: each is built once.
_STORES: dict[tuple[str, str, str], tuple] = {}


def _built(spark: SparkSession, kind: str, sf_dir: str, build: Callable[[SparkSession, str], tuple]) -> tuple:
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _STORES:
        _STORES[key] = build(spark, sf_dir)
    return _STORES[key]


def _arrived(spark: SparkSession, sf_dir: str) -> tuple[str, Layout]:
    """The profile of the raw table as it arrives in batches, compacted half-way."""
    root, raw = f"{shared_folder(spark)}/arriving-{uuid.uuid4().hex}", _raw(spark, sf_dir)
    raw.write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    at = Layout.of(raw)
    store = profile_store(f"{root}/parts", at)
    for i, (batch_id, batch) in enumerate(_batches(raw)):
        add_profile_batch(store, batch, batch_id, at)
        if i == 1:
            store.compact(spark)
    return store.root, at


def _arriving(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, at = _built(spark, "profile", sf_dir, _arrived)
        return stored_profile(spark, profile_store(root, at), at)[name]

    return run


def _summarised(spark: SparkSession, sf_dir: str) -> tuple[str]:
    store = summary_store(f"{shared_folder(spark)}/summarised-{uuid.uuid4().hex}")
    for i, (batch_id, batch) in enumerate(_batches(_transformed(spark, sf_dir))):
        add_summary_batch(store, batch, batch_id)
        if i == 2:
            store.compact(spark)
    return (store.root,)


def _maintained(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        (root,) = _built(spark, "summaries", sf_dir, _summarised)
        return stored_summaries(spark, summary_store(root))[name]

    return run


def _sql_analysis(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dict(run_script(spark, ANALYSES_SQL.read_text(), {"requests": _transformed(spark, sf_dir)}))[name]

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top complaint types per borough with shares, on sf0.001."""
    return A.top_categories_by_region(_transformed(spark, SF_SMOKE))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources / contract
        "identifier_strings": _on_raw(lambda df: cast_identifiers(df).select("unique_key", *IDENTIFIER_COLUMNS)),
        "csv_report": lambda spark, sf_dir: csv_report(spark, raw_csv_copy(spark, sf_dir)),
        "csv_requests": lambda spark, sf_dir: read_raw_csv(spark, raw_csv_copy(spark, sf_dir)),
        "inferred_schema": lambda spark, sf_dir: inferred_schema(_csv_text(spark, sf_dir)),
        "typed_requests": lambda spark, sf_dir: read_raw_csv(spark, raw_csv_copy(spark, sf_dir), numeric_types={}, infer=True),
        "csv_quarantine": lambda spark, sf_dir: _split_csv(spark, sf_dir, "judged"),
        "csv_good_records": lambda spark, sf_dir: _split_csv(spark, sf_dir, "good"),
        "quarantine_summary": lambda spark, sf_dir: _split_csv(spark, sf_dir, "summary"),
        "column_contract": _on_raw(lambda df: contract_report(df.drop("agency"), DEFAULT_ROLES.required)),
        "feature_contract": _on_transformed(lambda df: contract_report(df, DERIVED_FEATURE_COLUMNS)),
        "sql_view": _sql_view,
        # quality profile (raw table), incl. the fused headline counts
        **{name: _on_raw(check) for name, check in PROFILE_CHECKS.items()},
        # cleaning
        "parse_timestamps": _on_raw(
            lambda df: C.parse_timestamps(df).select("unique_key", "created_date", "closed_date", "resolution_updated")
        ),
        "normalize_placeholders": _on_raw(
            lambda df: C.normalize_placeholders(df).select("unique_key", *CLEANED_PLACEHOLDER_COLUMNS)
        ),
        "flag_invalid_dates": _on_raw(
            lambda df: C.flag_invalid_dates(C.parse_timestamps(df)).select(
                "unique_key", "created_date", "closed_date", "invalid_date_order"
            )
        ),
        "standardize_complaints": _on_raw(
            lambda df: C.standardize_categories(df, CATEGORY_SPELLING).select("unique_key", "complaint_type")
        ),
        "spelling_review": _on_raw(spelling_review),
        "standardize_by_review": _on_raw(lambda df: apply_spelling(df, spelling_review(df)).select("unique_key", "complaint_type")),
        "cleaning_gates_by_review": _on_raw(_reviewed_gates),
        "cleaning_gates": _on_cleaned(lambda df: G.cleaning_metrics(df, spelling=CATEGORY_SPELLING)),
        "cleaning_gates_violated": _on_raw(lambda df: G.cleaning_metrics(ungated_cleaned(df), spelling=CATEGORY_SPELLING)),
        "cleaned_requests": _cleaned,
        # transform
        "date_features": _on_cleaned(
            lambda df: add_date_features(df).select(
                "unique_key", "request_date", "request_year", "request_month", "request_day_of_week", "request_hour"
            )
        ),
        "resolution_time": _on_transformed(lambda df: df.select("unique_key", "status", "resolution_time_hours")),
        "transform_gates": _on_transformed(G.transform_metrics),
        "transform_gates_violated": _on_transformed(lambda df: G.transform_metrics(ungated_transformed(df))),
        "complaint_summary": _on_transformed(S.category_summary),
        "borough_summary": _on_transformed(S.region_summary),
        "agency_summary": _on_transformed(S.handler_summary),
        "date_summary": _on_transformed(S.date_summary),
        "transformed_requests": _transformed,
        "published_release": _published_release,
        # profile and summaries kept up to date from the parts of arriving batches
        **{f"arriving_{name}": _arriving(name) for name in ARRIVING},
        **{f"maintained_{name}": _maintained(name) for name in MAINTAINED},
        # the analyses as statements of a SQL file
        **{f"sql_{name}": _sql_analysis(name) for name in ("total_rows", "sample_features", *A.ANALYSES)},
        # analyses
        "total_rows": _on_transformed(A.total_rows),
        "sample_features": _on_transformed(A.sample_features),
        "top_complaints_by_borough": _on_transformed(A.top_categories_by_region),
        "high_volume_complaints": _on_transformed(A.high_volume_categories),
        "agency_workload_speed": _on_transformed(A.handler_workload_speed),
        "borough_coverage": _on_transformed(A.region_coverage),
        "peak_hours": _on_transformed(A.peak_hours),
        "weekday_pattern": _on_transformed(A.weekday_pattern),
        "daily_spikes": _on_transformed(A.daily_spikes),
        "peak_hour_by_complaint": _on_transformed(A.peak_hour_by_category),
        "complaint_resolution_by_borough": _on_transformed(A.category_resolution_by_region),
        # the same operators on a second table, under its own column names
        "lines_duplicate_keys": _on_lines(Q.duplicate_keys, raw_lines),
        "lines_status_counts": _on_lines(Q.status_counts, raw_lines),
        "lines_missing_closed_by_status": _on_lines(Q.missing_closed_by_status, raw_lines),
        "lines_invalid_date_rows": _on_lines(Q.invalid_date_rows, raw_lines),
        "lines_type_ranking": _on_lines(Q.category_ranking, raw_lines),
        "lines_cleaning_gates": _on_lines(functools.partial(G.cleaning_metrics, spelling=LINE_SPELLING), _cleaned_lines),
        "lines_transform_gates": _on_lines(G.transform_metrics),
        "lines_transformed": _transformed_lines,
        "lines_type_summary": _on_lines(S.category_summary),
        "lines_region_summary": _on_lines(S.region_summary),
        "lines_supplier_summary": _on_lines(S.handler_summary),
        "lines_date_summary": _on_lines(S.date_summary),
        "lines_top_types_by_region": _on_lines(A.top_categories_by_region),
        "lines_high_volume_types": _on_lines(A.high_volume_categories),
        "lines_supplier_workload_speed": _on_lines(A.handler_workload_speed),
        "lines_region_coverage": _on_lines(A.region_coverage),
        "lines_weekday_pattern": _on_lines(A.weekday_pattern),
        "lines_daily_spikes": _on_lines(A.daily_spikes),
        "lines_type_resolution_by_region": _on_lines(A.category_resolution_by_region),
        # corpus operators and their pipeline
        **CORPUS_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    from reqlens.oracle import ORACLE

    return {**ORACLE, **CORPUS_ORACLE}
