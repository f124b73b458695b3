import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from reqlens.plans.pipeline import run_pipeline
from reqlens.sources.files import read_raw_csv
from reqlens.sources.release import current_release
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from tests.conftest import SF001
from tests.fixtures import ROW_COUNT, write_raw_csv


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["borough", "complaint_type", "num_complaints", "complaint_rank",
                          "complaint_share_percentage"]
    assert df.count() > 0


def test_pipeline_on_test_tables(spark, tmp_path):
    raw = raw_requests(spark, SF001)
    res = run_pipeline(spark, raw, str(tmp_path / "out"), spelling=CATEGORY_SPELLING)
    n = raw.count()
    assert res.cleaning_metrics["row_count"] == n == res.transform_metrics["row_count"]
    t = spark.read.parquet(res.transformed_path)
    assert len(t.columns) == len(raw.columns) + 1 + 6
    for name, path in res.summary_paths.items():
        s = spark.read.parquet(path)
        assert s.agg(F.sum("request_count")).first()[0] == n, name
    assert set(res.analyses) >= {"peak_hours", "weekday_pattern"}
    assert res.analyses["peak_hours"].count() > 0


def test_pipeline_from_csv(spark, tmp_path):
    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path)))
    res = run_pipeline(spark, raw, str(tmp_path / "out"))
    assert res.transform_metrics["row_count"] == ROW_COUNT
    cleaned = spark.read.parquet(res.cleaned_path)
    assert len(cleaned.columns) == 25  # 24 + invalid_date_order
    assert len(spark.read.parquet(res.transformed_path).columns) == 31


def test_failed_gate_writes_nothing(spark, tmp_path):
    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path)))
    out = str(tmp_path / "bad")
    with pytest.raises(ValueError, match="unstandardized"):
        # a spelling map whose fixes are undone again: the gate must stop the write
        run_pipeline(spark, raw.withColumn("complaint_type", F.lit("x")), out, spelling={"x": "x"})
    assert current_release(spark, out) is None


def test_profile_stage_matches_direct_checks(spark, tmp_path):
    from reqlens.operators import quality as Q
    from reqlens.plans.pipeline import PROFILE_CHECKS, profile_stage

    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path)))
    prof = profile_stage(spark, raw, str(tmp_path / "profile"))
    assert set(prof) == set(PROFILE_CHECKS)
    assert sorted(prof["status_counts"].collect(), key=repr) == sorted(Q.status_counts(raw).collect(), key=repr)
    assert prof["full_row_duplicates"].first().duplicate_rows == 1
    assert prof["quality_counts"].first().row_count == ROW_COUNT
    for name, df in prof.items():
        df.collect()  # every check runs on the staged copy


def test_partitioned_transformed_layer(spark, tmp_path):
    from collections import Counter

    from reqlens.plans.analyses import ANALYSES

    raw = raw_requests(spark, SF001)
    flat = run_pipeline(spark, raw, str(tmp_path / "flat"), spelling=CATEGORY_SPELLING)
    parted = run_pipeline(spark, raw, str(tmp_path / "parted"), spelling=CATEGORY_SPELLING,
                          partition_transformed_by=("request_year", "request_month"))
    assert any(p.startswith("request_year=") for p in os.listdir(parted.transformed_path))
    for name in ANALYSES:
        a = Counter(tuple(r) for r in flat.analyses[name].collect())
        b = Counter(tuple(r) for r in parted.analyses[name].collect())
        assert a == b, name


def test_failed_gate_keeps_the_last_layer(spark, tmp_path):
    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path)))
    out = str(tmp_path / "out")
    good = run_pipeline(spark, raw, out, with_analyses=False)
    before = sorted(spark.read.parquet(good.cleaned_path).collect(), key=repr)
    with pytest.raises(ValueError, match="unstandardized"):
        run_pipeline(spark, raw.withColumn("complaint_type", F.lit("x")), out, spelling={"x": "x"})
    spark.catalog.clearCache()
    assert sorted(current_release(spark, out).read(spark, "cleaned").collect(), key=repr) == before
    run_pipeline(spark, raw.where("unique_key < 5"), out, with_analyses=False)  # a good run replaces it
    assert current_release(spark, out).read(spark, "cleaned").count() == 4


def test_partitioned_layer_has_few_files(spark, tmp_path):
    raw = raw_requests(spark, SF001).repartition(8)
    res = run_pipeline(spark, raw, str(tmp_path / "p"), spelling=CATEGORY_SPELLING, with_analyses=False,
                       partition_transformed_by=("request_year", "request_month"))
    months = list(Path(res.transformed_path).glob("request_year=*/request_month=*"))
    assert months and all(len(list(m.glob("*.parquet"))) == 1 for m in months)
    assert spark.read.parquet(res.transformed_path).count() == raw.count()
