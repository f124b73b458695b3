import pytest
from pyspark.sql import functions as F

from reqlens.sources.files import ingest_report, read_parquet, read_raw_csv, validate_columns, write_parquet
from tests.fixtures import ROW_COUNT, write_raw_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_raw_csv(spark, write_raw_csv(str(tmp_path_factory.mktemp("csv"))))


def test_roles_and_types(raw):
    types = dict(raw.dtypes)
    assert types["unique_key"] == "bigint"
    assert types["latitude"] == "double" and types["longitude"] == "double"
    assert types["incident_zip"] == "string"
    assert types["created_date"] == "string"  # parsed later, by cleaning
    assert "complaint_type" in types and "resolution_updated" in types and "taxi_company_borough" in types


def test_leading_zeros_kept(raw):
    assert raw.where(F.col("unique_key") == 1).first()["incident_zip"] == "00083"


def test_blank_field_is_null_but_spaces_survive(raw):
    row16 = raw.where(F.col("unique_key") == 16).first()
    assert row16["agency"] is None
    assert row16["complaint_type"] == "  "


def test_ingest_report(raw):
    r = ingest_report(raw).first()
    assert r["row_count"] == ROW_COUNT and r["column_count"] == 24


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "nope.csv"))


def test_missing_required_column(raw):
    with pytest.raises(ValueError, match="status"):
        validate_columns(raw.drop("status"))
    assert validate_columns(raw) is True


def test_parquet_round_trip(spark, raw, tmp_path):
    path = write_parquet(raw, str(tmp_path / "out"))
    back = read_parquet(spark, path)
    assert back.schema == raw.schema
    assert sorted(back.collect()) == sorted(raw.collect())
    with pytest.raises(FileNotFoundError):
        read_parquet(spark, str(tmp_path / "missing"))


def test_explicit_schema(spark, tmp_path):
    path = write_raw_csv(str(tmp_path))
    schema = ", ".join(f"`{h}` string" for h in __import__("tests.fixtures", fromlist=["HEADERS"]).HEADERS)
    df = read_raw_csv(spark, path, schema=schema)
    assert dict(df.dtypes)["unique_key"] == "string"
    assert df.count() == ROW_COUNT


def test_rfc4180_quotes_and_multiline(spark, tmp_path):
    from tests.fixtures import HEADERS

    header = ",".join(f'"{h}"' if "," in h else h for h in HEADERS)
    blank = [""] * (len(HEADERS) - 2)
    row1 = ["1", '"He said ""loud"", then left"'] + blank
    row2 = ["2", '"line one\nline two"'] + blank
    order = ["Unique Key", "Resolution Description"] + [h for h in HEADERS if h not in ("Unique Key", "Resolution Description")]
    text = ",".join(order) + "\n" + ",".join(row1) + "\n" + ",".join(row2) + "\n"
    path = tmp_path / "q.csv"
    path.write_text(text)
    df = read_raw_csv(spark, str(path), multiline=True, validate=False)
    got = {r.unique_key: r.resolution_description for r in df.collect()}
    assert got == {1: 'He said "loud", then left', 2: "line one\nline two"}
    from reqlens.sources.files import register_parquet_view

    register_parquet_view(spark, write_parquet(df, str(tmp_path / "p")), "reqs")
    assert spark.sql("SELECT COUNT(*) AS n FROM reqs").first().n == 2


def test_swapped_columns_stop_the_read(spark, tmp_path):
    for name, header, row in (("a", "Agency,Status", "HSG,Open"), ("b", "Status,Agency", "Open,HSG")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{row}\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path), validate=False).collect()


def test_csv_report_counts_what_did_not_parse(spark, tmp_path):
    from reqlens.sources.files import csv_report

    (tmp_path / "r.csv").write_text("Unique Key,Agency,Latitude\nabc,HSG,1.5\nxyz,ENV,north\n3,POL,\n4\n5,a,2.0,extra\n")
    got = {r.metric: r.value for r in csv_report(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"rows": 5, "columns": 3, "malformed_records": 2, "bad_unique_key": 2, "bad_latitude": 1}


def test_contract_report(raw):
    from reqlens.sources.files import contract_report

    got = {r.required_column: (r.present, r.filled_rows) for r in contract_report(raw, ["unique_key", "nope"]).collect()}
    assert got == {"unique_key": (True, ROW_COUNT), "nope": (False, 0)}
