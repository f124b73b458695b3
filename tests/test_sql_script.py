import pytest

from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.plans.analyses import ANALYSES, sample_features, total_rows
from reqlens.plans.sql_script import ANALYSES_SQL, read_statements, run_script
from reqlens.sources.files import read_raw_csv
from tests.fixtures import write_raw_csv


def test_statements():
    script = """
    -- a note; not the end
    -- title: First one
    SELECT ';' AS a, "x;--y" AS b, `c;d` /* ; /* nested ; */ still; */ FROM t; ; -- title: lost
    ;
    SELECT 'it''s; fine', 'a\\';b' -- tail; comment
    ;
    /* only a comment; */
    -- title: Last
    SELECT 1
    """
    got = read_statements(script)
    assert [s.title for s in got] == ["First one", "Statement 2", "Last"]
    assert got[0].text == """SELECT ';' AS a, "x;--y" AS b, `c;d`   FROM t"""
    assert got[1].text.startswith("SELECT 'it''s; fine', 'a\\';b'") and got[2].text == "SELECT 1"
    assert read_statements("") == read_statements(" ;; -- nothing\n;") == []
    assert read_statements("SELECT 1 /* open ; ")[0].text == "SELECT 1"


def test_results_are_frames_and_definitions_hold(spark):
    script = "CREATE OR REPLACE TEMP VIEW twice AS SELECT 2 * id AS id FROM numbers;\n-- title: sum\nSELECT sum(id) AS s FROM twice"
    assert [(t, df.first().s) for t, df in run_script(spark, script, {"numbers": spark.range(4)})] == [("sum", 12)]


@pytest.fixture(scope="module")
def transformed(spark, tmp_path_factory):
    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path_factory.mktemp("sql"))))
    return transform_requests(clean_requests(raw)).persist()


def test_sql_file_equals_the_dataframe_analyses(spark, transformed):
    frames = {"total_rows": total_rows, "sample_features": sample_features, **ANALYSES}
    results = run_script(spark, ANALYSES_SQL.read_text(), {"requests": transformed})
    assert [title for title, _ in results] == list(frames)
    for title, df in results:
        want = frames[title](transformed)
        assert df.columns == want.columns, title
        assert list(map(tuple, df.collect())) == list(map(tuple, want.collect())), title


def test_sql_file_on_an_empty_table(spark, transformed):
    for title, df in run_script(spark, ANALYSES_SQL.read_text(), {"requests": transformed.limit(0)}):
        assert df.count() == (1 if title == "total_rows" else 0), title
