import pytest

import tests.brute as B
from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.operators.summaries import category_summary, date_summary, region_summary
from reqlens.plans import analyses as A
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from tests.conftest import SF001


@pytest.fixture(scope="module")
def transformed(spark):
    df = transform_requests(clean_requests(raw_requests(spark, SF001), spelling=CATEGORY_SPELLING))
    return df.cache()


@pytest.fixture(scope="module")
def rows(transformed):
    return [r.asDict() for r in transformed.collect()]


def _tuples(df):
    return {tuple(r) for r in df.collect()}


def test_q1(transformed, rows):
    assert _tuples(A.top_categories_by_region(transformed)) == B.top_complaints_by_borough(rows)
    assert _tuples(A.top_categories_by_region(transformed, top_n=1)) == B.top_complaints_by_borough(rows, 1)


def test_q2(transformed, rows):
    assert _tuples(A.high_volume_categories(transformed)) == B.high_volume_complaints(rows)


def test_q3(transformed, rows):
    assert _tuples(A.handler_workload_speed(transformed)) == B.agency_workload_speed(rows)


def test_q4(transformed, rows):
    assert _tuples(A.region_coverage(transformed)) == B.borough_coverage(rows)


def test_q5(transformed, rows):
    got = _tuples(A.peak_hours(transformed))
    assert got == B.peak_hours(rows)
    assert abs(sum(t[3] for t in got) - 100) < 0.2


def test_q6(transformed, rows):
    assert _tuples(A.weekday_pattern(transformed)) == B.weekday_pattern(rows)
    order = [r.request_day_of_week for r in A.weekday_pattern(transformed).collect()]
    assert order == [d for d in ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
                     if d in order]


def test_q7(transformed, rows):
    assert _tuples(A.daily_spikes(transformed)) == B.daily_spikes(rows)


def test_q8(transformed, rows):
    assert _tuples(A.peak_hour_by_category(transformed)) == B.peak_hour_by_complaint(rows)
    assert _tuples(A.peak_hour_by_category(transformed, top_n=2, top_hours=1)) == B.peak_hour_by_complaint(rows, 2, 1)


@pytest.mark.parametrize("min_resolved", [1, 5, 100])
def test_q9(transformed, rows, min_resolved):
    got = _tuples(A.category_resolution_by_region(transformed, min_resolved=min_resolved))
    assert got == B.complaint_resolution_by_borough(rows, min_resolved=min_resolved)


def test_summaries_add_up(transformed, rows):
    n = len(rows)
    for summary in (category_summary(transformed), region_summary(transformed), date_summary(transformed)):
        assert sum(r.request_count for r in summary.collect()) == n
    assert A.total_rows(transformed).first().total_rows == n
    assert A.sample_features(transformed).count() == 5


def test_registry(transformed):
    out = A.run_analyses(transformed, ["peak_hours", "daily_spikes"])
    assert set(out) == {"peak_hours", "daily_spikes"}
    assert set(A.ANALYSES) == {
        "top_complaints_by_borough", "high_volume_complaints", "agency_workload_speed", "borough_coverage",
        "peak_hours", "weekday_pattern", "daily_spikes", "peak_hour_by_complaint", "complaint_resolution_by_borough"}


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_deterministic_under_partitioning(spark, transformed, partitions):
    base = {name: _tuples(fn(transformed)) for name, fn in A.ANALYSES.items()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name, fn in A.ANALYSES.items():
            assert _tuples(fn(transformed.repartition(int(partitions)))) == base[name], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_null_category_can_take_a_top_slot(spark):
    """NULL is the biggest category: it occupies rank 1, so with top_n=2 only one named category is reported."""
    rows = []
    key = 0
    for cat, n in ((None, 9), ("a", 5), ("b", 4), ("c", 3)):
        for i in range(n):
            key += 1
            rows.append((key, cat, "X", i % 3, 1.0 + i))
    df = spark.createDataFrame(
        rows, "unique_key long, complaint_type string, borough string, request_hour int, resolution_time_hours double"
    )
    dict_rows = [r.asDict() for r in df.collect()]
    got = _tuples(A.peak_hour_by_category(df, top_n=2))
    assert {t[0] for t in got} == {"a"}
    assert got == B.peak_hour_by_complaint(dict_rows, top_n=2)
    got9 = _tuples(A.category_resolution_by_region(df, top_n=2, min_resolved=1))
    assert got9 == B.complaint_resolution_by_borough(dict_rows, top_n=2, min_resolved=1)
    assert {t[0] for t in got9} == {"a"}


def test_category_rank_ties(spark):
    """Two categories tie for first: RANK gives 1, 1, 3 (top_n=2 keeps both tied ones only)."""
    rows = []
    key = 0
    for cat, n in (("a", 4), ("b", 4), ("c", 3), ("d", 1)):
        for i in range(n):
            key += 1
            rows.append((key, cat, "X", i % 2, float(i)))
    df = spark.createDataFrame(
        rows, "unique_key long, complaint_type string, borough string, request_hour int, resolution_time_hours double"
    )
    dict_rows = [r.asDict() for r in df.collect()]
    for top_n in (1, 2, 3):
        got = _tuples(A.peak_hour_by_category(df, top_n=top_n))
        assert got == B.peak_hour_by_complaint(dict_rows, top_n=top_n), top_n
    assert {t[0] for t in _tuples(A.peak_hour_by_category(df, top_n=2))} == {"a", "b"}


def test_grouping_sets_summaries_equal_one_by_one(transformed):
    from reqlens.operators.summaries import handler_summary, split_summary_groups, summary_groups

    split = split_summary_groups(summary_groups(transformed))
    one_by_one = {
        "complaints_summary": category_summary(transformed),
        "borough_summary": region_summary(transformed),
        "agency_summary": handler_summary(transformed),
        "date_summary": date_summary(transformed),
    }
    for name, df in one_by_one.items():
        assert split[name].columns == df.columns, name
        assert split[name].collect() == df.collect(), name
