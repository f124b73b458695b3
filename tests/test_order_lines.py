"""The engine on a second table with columns of its own names (``test_oracle.py`` holds its queries to SQL)."""

from collections import Counter

import pytest

from reqlens.operators import clean as C
from reqlens.operators import quality as Q
from reqlens.operators.features import transform_requests
from reqlens.plans import analyses as A
from reqlens.plans.pipeline import run_pipeline
from reqlens.sources.order_lines import LINE_ROLES, LINE_SPELLING, raw_lines
from reqlens.sources.release import current_release
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tables(tmp_path_factory, spark):
    """A line of a known order, one of an unknown one, one shipped too early, one still open, one sent twice."""
    root = str(tmp_path_factory.mktemp("lines"))
    days = lambda *x: f"timestamp_ntz'{x[0]}-{x[1]:02d}-{x[2]:02d} 00:00:00'"
    d1, d2, d3 = days(2024, 1, 1), days(2024, 1, 2), days(2024, 1, 3)
    sql = {
        "region": "VALUES (0, 'NORTH') t(r_regionkey, r_name)",
        "nation": "VALUES (5, 'N5', 0) t(n_nationkey, n_name, n_regionkey)",
        "customer": "VALUES (10L, 5), (11L, 99) t(c_custkey, c_nationkey)",
        "orders": f"VALUES (1L, 10L, {d2}), (2L, 11L, {d2}) t(o_orderkey, o_custkey, o_orderdate)",
        "part": "VALUES (7L, 'ECONOMY'), (8L, 'SMALL') t(p_partkey, p_type)",
        "supplier": "VALUES (3L, 'S3') t(s_suppkey, s_name)",
        "lineitem": f"""VALUES (1L, 7L, 3L, 1, 'F', {d3}), (9L, 8L, 3L, 1, 'F', {d3}), (1L, 8L, 4L, 2, 'F', {d1}),
                        (2L, 7L, 3L, 1, 'O', {d3}), (1L, 7L, 3L, 1, 'F', {d3})
                        t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_shipdate)""",
    }
    for name, rows in sql.items():
        spark.sql(f"SELECT * FROM {rows}").write.parquet(f"{root}/{name}.parquet")
    return root


def _transformed(spark, sf_dir):
    return transform_requests(C.clean_requests(raw_lines(spark, sf_dir), spelling=LINE_SPELLING, roles=LINE_ROLES), roles=LINE_ROLES)


def test_every_line_is_a_request(spark, tables):
    rows = _transformed(spark, tables).select(
        "line_id", "p_type", "r_name", "s_name", "shipped_before_ordered", "resolution_time_hours"
    )
    assert Counter(tuple(r) for r in rows.collect()) == {
        (9, "Economy", "NORTH", "S3", False, 24.0): 2,
        (73, "SMALL", None, "S3", False, None): 1,  # an unknown order: no date, no place
        (10, "SMALL", "NORTH", None, True, None): 1,
        (17, "Economy", None, "S3", False, None): 1,  # still open; a customer of no known nation
    }


def test_checks_under_these_roles(spark, tables):
    raw = raw_lines(spark, tables)
    assert [tuple(r) for r in Q.duplicate_keys(raw, roles=LINE_ROLES).collect()] == [(1,)]
    assert {tuple(r) for r in Q.status_counts(raw, roles=LINE_ROLES).collect()} == {("F", 4), ("O", 1)}
    assert [r.line_id for r in Q.invalid_date_rows(raw, roles=LINE_ROLES).collect()] == [10]


def test_analyses_under_these_roles(spark, tables):
    df = _transformed(spark, tables)
    assert [tuple(r) for r in A.top_categories_by_region(df, roles=LINE_ROLES).collect()] == [
        ("NORTH", "Economy", 2, 1, 66.67), ("NORTH", "SMALL", 1, 2, 33.33),
    ]
    assert [tuple(r) for r in A.handler_workload_speed(df, roles=LINE_ROLES).collect()] == [("S3", 4, 2, 24.0, 1, 1), (None, 1, 0, None, 2, None)]
    assert [tuple(r) for r in A.category_resolution_by_region(df, min_resolved=1, roles=LINE_ROLES).collect()] == [
        ("Economy", "NORTH", 2, 24.0, 1)
    ]


def test_pipeline_over_all_lines(spark, tmp_path):
    raw = raw_lines(spark, SF001)
    run_pipeline(spark, raw, str(tmp_path / "lines"), spelling=LINE_SPELLING, roles=LINE_ROLES, with_analyses=False)
    release = current_release(spark, str(tmp_path / "lines"))
    n = raw.count()
    assert n > 1000 and release.read(spark, "transformed").count() == n
    for name in ("complaints_summary", "borough_summary", "agency_summary", "date_summary"):
        assert release.read(spark, name).agg({"request_count": "sum"}).first()[0] == n, name


def test_only_needed_columns_are_read(spark, capsys):
    A.region_coverage(_transformed(spark, SF001), roles=LINE_ROLES).explain("formatted")
    plan = capsys.readouterr().out
    assert "l_linenumber" not in plan.split("ReadSchema", 1)[1] and "p_type" not in plan and "s_name" not in plan
