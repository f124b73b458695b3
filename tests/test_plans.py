"""Plan-shape regressions: single scan, pruned reads, pushed filters, partial aggregation."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.plans import analyses as A
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from tests.conftest import SF001


@pytest.fixture(scope="module")
def transformed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "transformed")
    transform_requests(clean_requests(raw_requests(spark, SF001), spelling=CATEGORY_SPELLING)).write.parquet(path)
    return spark.read.parquet(path)


def _final_plan(df) -> str:
    df.collect()  # executes this DataFrame's own plan, so explain() shows the final AQE plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    assert "AdaptiveSparkPlan" not in text or "isFinalPlan=true" in text
    return text.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(A.ANALYSES))
def test_analysis_plan_shape(transformed, name):
    plan = _final_plan(A.ANALYSES[name](transformed))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(scans) == 1 or name == "high_volume_complaints" and len(scans) <= 2, f"{name}: {len(scans)} scans"
    assert len(scans[0].split(",")) <= 3, f"{name} reads {scans[0]}"
    # the one join is against a one-row aggregate; handlers also join their ranks, by distinct value
    assert name == "agency_workload_speed" or "SortMergeJoin" not in plan and ("NestedLoopJoin" not in plan or name == "high_volume_complaints")
    # the first shuffle after the scan carries partially aggregated rows only
    lines = plan.splitlines()
    scan_at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    above = [line for line in lines[:scan_at] if "Exchange" in line or "HashAggregate" in line]
    assert "partial_" in above[-1] and "HashAggregate" in above[-1], name


@pytest.mark.parametrize("name", ["top_complaints_by_borough", "borough_coverage"])
def test_region_filter_reaches_scan(transformed, name):
    plan = _final_plan(A.ANALYSES[name](transformed))
    assert "NOT (borough#" in plan and "= Unspecified)" in plan
    assert re.search(r"DataFilters: \[[^\]]*NOT \(borough#\d+ = Unspecified\)", plan)


def test_top_k_trimmed_per_task(transformed):
    plan = _final_plan(A.top_categories_by_region(transformed))
    assert "WindowGroupLimit" in plan


@pytest.fixture(scope="module")
def many_categories(spark, tmp_path_factory):
    """50,000 categories, ties among the largest, and a NULL one."""
    path = str(tmp_path_factory.mktemp("many") / "t")
    c = F.when(F.col("id") % 1000 < 400, F.concat(F.lit("hot"), F.col("id") % 12)).when(F.col("id") % 1000 == 999, F.lit(None))
    rows = spark.range(120_000).select(
        c.otherwise(F.concat(F.lit("c"), (F.col("id") % 50_000).cast("string"))).alias("complaint_type"),
        (F.col("id") % 24).cast("int").alias("request_hour"),
        F.concat(F.lit("R"), (F.col("id") % 5).cast("string")).alias("borough"),
        F.lit(1.0).alias("resolution_time_hours"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("fn", [A.peak_hour_by_category, A.category_resolution_by_region])
def test_top_groups_trimmed_before_the_single_exchange(many_categories, fn):
    plan = _final_plan(fn(many_categories))
    single = plan.split("Exchange SinglePartition", 1)
    assert len(single) == 2 and re.search("WindowGroupLimit.*Partial", single[1].split("Exchange")[0])
    assert plan.count("FileScan parquet") == 1


def test_high_volume_ranks_nothing_in_one_task(many_categories):
    plan = _final_plan(A.high_volume_categories(many_categories))
    assert "Window" not in plan
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part.split("\n")[1]  # one partial row per task
