import json

import pytest

from reqlens.sources.files import read_raw_csv
from reqlens.sources.quarantine import Rules, good_records, quarantine_summary, quarantined_records, split_raw_csv
from tests.fixtures import HEADERS, ROW_COUNT, raw_csv_text


@pytest.fixture
def export(tmp_path):
    lines = raw_csv_text().splitlines()
    first = lines[1].split(",")
    bad = {
        "short": ",".join(first[:4]),
        "long": lines[1] + ",one,two",
        "no key": "," + lines[1].split(",", 1)[1],
        "blank key": " ," + lines[1].split(",", 1)[1],
    }
    src = tmp_path / "raw"
    src.mkdir()
    (src / "a.csv").write_text("\n".join([lines[0], *lines[1:], bad["short"]]) + "\n")
    (src / "b.csv").write_text("\n".join([lines[0], bad["long"], bad["no key"], bad["blank key"]]) + "\n")
    return str(src), bad


def test_every_record_goes_one_way(spark, export, tmp_path):
    path, bad = export
    out = str(tmp_path / "split")
    counts = split_raw_csv(spark, path, out)
    assert counts == {"records": ROW_COUNT + 4, "good": ROW_COUNT, "quarantined": 4, "fields": 2, "missing:unique_key": 2}
    good, held = good_records(spark, out), quarantined_records(spark, out)
    assert good.count() == ROW_COUNT and held.count() == 4
    lines = {r["record"]: (r["reasons"], r["source_file"].rsplit("/", 1)[1]) for r in held.collect()}
    assert lines[bad["short"]] == (["fields"], "a.csv") and lines[bad["long"]] == (["fields"], "b.csv")
    rest = [(json.loads(k).get("unique_key"), v) for k, v in lines.items() if k.startswith("{")]
    assert sorted(rest, key=str) == [(" ", (["missing:unique_key"], "b.csv")), (None, (["missing:unique_key"], "b.csv"))]
    assert sorted(map(tuple, quarantine_summary(held.select("reasons", held.source_file.substr(-5, 5).alias("source_file"))).collect())) == [
        ("a.csv", "fields", 1), ("b.csv", "fields", 1), ("b.csv", "missing:unique_key", 2),
    ]


def test_good_records_are_what_the_reader_gives(spark, tmp_path):
    src = tmp_path / "raw.csv"
    src.write_text(raw_csv_text())
    out = str(tmp_path / "split")
    split_raw_csv(spark, str(src), out)
    read = read_raw_csv(spark, str(src))
    assert good_records(spark, out).dtypes == read.dtypes and len(read.columns) == len(HEADERS)
    assert sorted(good_records(spark, out).collect(), key=repr) == sorted(read.collect(), key=repr)


def test_stricter_rules_and_several_reasons(spark, tmp_path):
    header, line = raw_csv_text().splitlines()[:2]
    at = {h: i for i, h in enumerate(header.split(","))}
    fields = line.split(",")
    fields[at["Latitude"]], fields[at["Created Date"]] = "north", "soon"
    src = tmp_path / "raw.csv"
    src.write_text("\n".join([header, line, ",".join(fields)]) + "\n")
    out = str(tmp_path / "split")
    counts = split_raw_csv(spark, str(src), out, Rules(numbers=("latitude",), dates=("created_date",)))
    assert (counts["good"], counts["quarantined"]) == (1, 1)
    assert quarantined_records(spark, out).first()["reasons"] == ["number:latitude", "date:created_date"]
    assert split_raw_csv(spark, str(src), out)["good"] == 2  # by default a stray value becomes NULL


def test_all_good_and_missing_path(spark, tmp_path):
    src = tmp_path / "raw.csv"
    src.write_text(raw_csv_text())
    out = str(tmp_path / "split")
    assert split_raw_csv(spark, str(src), out)["quarantined"] == 0
    assert quarantined_records(spark, out).count() == 0
    with pytest.raises(FileNotFoundError):
        split_raw_csv(spark, str(tmp_path / "none.csv"), out)
