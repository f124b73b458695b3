import contextlib
import io

from reqlens.cli import main
from tests.fixtures import ROW_COUNT, write_raw_csv


def _run(spark, *argv) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(list(argv), spark=spark) == 0
    return buf.getvalue()


def test_cli_stages(spark, tmp_path):
    raw = write_raw_csv(str(tmp_path))
    out = str(tmp_path / "out")
    assert f"|{ROW_COUNT}" in _run(spark, "ingest", raw).replace(" ", "")
    inspected = _run(spark, "--rows", "5", "inspect", raw, out)
    assert "Placeholder counts" in inspected and "Schema" in inspected
    assert "validated" in _run(spark, "clean", raw, out)
    assert "Summaries" in _run(spark, "transform", out)
    text = _run(spark, "analyze", out, "--only", "peak_hours")
    assert "Analysis 1: Requests per hour of day" in text and "10:00" in text
    assert text.count("Analysis ") == 1
    assert _run(spark, "sql", out).count("Query ") == 11
    script = tmp_path / "own.sql"
    script.write_text("-- title: Closed ones\nSELECT count(*) AS closed FROM requests WHERE status = 'Closed';")
    assert "Query 1: Closed ones" in _run(spark, "sql", out, str(script))
    assert f"'good': {ROW_COUNT}" in _run(spark, "split", raw, str(tmp_path / "split"))
    assert f"|{ROW_COUNT}" in _run(spark, "--infer", "ingest", raw).replace(" ", "")


def test_cli_pipeline(spark, tmp_path):
    raw = write_raw_csv(str(tmp_path))
    text = _run(spark, "--rows", "3", "pipeline", raw, str(tmp_path / "p"))
    assert text.count("Analysis ") == 9
