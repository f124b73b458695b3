import pytest
from pyspark.sql import functions as F

from reqlens.operators.clean import clean_requests, flag_invalid_dates, normalize_placeholders, parse_timestamps
from reqlens.operators.features import transform_requests
from reqlens.operators.gates import check_cleaning, check_transform, cleaning_metrics, transform_metrics
from reqlens.sources.files import read_raw_csv
from tests.fixtures import ROW_COUNT, write_raw_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_raw_csv(spark, write_raw_csv(str(tmp_path_factory.mktemp("csv"))))


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean_requests(raw)


@pytest.fixture(scope="module")
def transformed(cleaned):
    return transform_requests(cleaned)


def _by_key(df, key):
    return df.where(F.col("unique_key") == key).first()


def test_parse_types_and_nulls(cleaned):
    types = dict(cleaned.dtypes)
    for c in ("created_date", "closed_date", "resolution_updated"):
        assert types[c] == "timestamp_ntz"
    assert _by_key(cleaned, 7)["created_date"] is None  # garbage
    assert _by_key(cleaned, 8)["created_date"] is None  # unpadded
    assert _by_key(cleaned, 9)["created_date"].hour == 0  # 12:00:00 AM


def test_placeholders_only_exact_na(cleaned):
    assert _by_key(cleaned, 1)["detail"] is None  # 'N/A'
    assert _by_key(cleaned, 2)["detail"] == "NA"
    assert _by_key(cleaned, 3)["detail"] == "NULL"
    assert _by_key(cleaned, 1)["additional_details"] == "None"


def test_flag(cleaned):
    flags = {r.unique_key: r.invalid_date_order for r in cleaned.select("unique_key", "invalid_date_order").collect()}
    assert flags[6] is True
    assert flags[4] is False and flags[7] is False  # NULL on one side -> false
    assert flags[2] is False  # equal dates
    assert sum(flags.values()) == 1


def test_spelling(cleaned):
    types = {r.unique_key: r.complaint_type for r in cleaned.select("unique_key", "complaint_type").collect()}
    assert types[1] == "Elevator" and types[3] == "Plumbing" and types[16] == "  " and types[17] is None


def test_idempotent(cleaned):
    again = flag_invalid_dates(normalize_placeholders(parse_timestamps(cleaned)))
    assert sorted(again.collect()) == sorted(cleaned.collect())


def test_cleaning_gates_pass(cleaned):
    m = check_cleaning(cleaned)
    assert m == {"row_count": ROW_COUNT, "flag_mismatch_rows": 0, "remaining_placeholders": 0,
                 "unstandardized_categories": 0}


@pytest.mark.parametrize(
    "corrupt, label",
    [
        (lambda df: df.withColumn("invalid_date_order", F.lit(False)), "flag_mismatch_rows"),
        (lambda df: df.withColumn("detail", F.lit("N/A")), "remaining_placeholders"),
        (lambda df: df.withColumn("complaint_type", F.lit("ELEVATOR")), "unstandardized"),
        # stricter than the source: a true flag with a NULL date is caught too
        (lambda df: df.withColumn("invalid_date_order", F.col("unique_key") == 4), "flag_mismatch_rows"),
    ],
)
def test_cleaning_gates_fail(cleaned, corrupt, label):
    with pytest.raises(ValueError, match=label):
        check_cleaning(corrupt(cleaned))


def test_features(transformed):
    r = _by_key(transformed, 1)
    assert (r.request_year, r.request_month, r.request_hour) == (2026, 1, 10)
    assert r.request_day_of_week == "Monday" and str(r.request_date) == "2026-01-05"
    assert _by_key(transformed, 7)["request_date"] is None


def test_resolution_time(transformed):
    hours = {r.unique_key: r.resolution_time_hours
             for r in transformed.select("unique_key", "resolution_time_hours").collect()}
    assert hours[1] == 2.5
    assert hours[2] == 0.0
    assert hours[3] == 0.01  # 18 s rounds up
    assert hours[4] is None  # closed without closed date
    assert hours[5] is None  # pending
    assert hours[6] is None  # invalid order
    assert hours[7] is None  # created unparseable
    assert hours[13] is None  # NULL status
    assert hours[9] == 1.0


def test_transform_gates(transformed):
    m = check_transform(transformed, ROW_COUNT)
    assert m["row_count"] == ROW_COUNT and m["negative_resolution"] == 0
    with pytest.raises(ValueError, match="rows after the transform"):
        check_transform(transformed, ROW_COUNT + 1)
    with pytest.raises(ValueError, match="lacks derived columns"):
        check_transform(transformed.drop("request_hour"))
    bad = transformed.withColumn("resolution_time_hours", F.lit(-1.0))
    with pytest.raises(ValueError, match="negative"):
        check_transform(bad)
    row = transform_metrics(bad).first()
    assert row.non_closed_with_resolution > 0 and row.unresolved_with_resolution > 0
    assert row.flagged_with_resolution == 1


def test_metrics_are_one_row(cleaned):
    assert cleaning_metrics(cleaned).count() == 1


def test_typed_timestamps_become_wall_clock(spark):
    df = spark.createDataFrame(
        [(1, "2026-01-05 10:00:00", "2026-01-05 12:30:18")], "unique_key long, c string, d string"
    ).select(
        "unique_key",
        F.col("c").cast("timestamp").alias("created_date"),
        F.col("d").cast("timestamp").alias("closed_date"),
        F.lit("Closed").alias("status"),
    )
    out = transform_requests(clean_requests(df)).first()
    assert str(out.created_date) == "2026-01-05 10:00:00"
    assert out.resolution_time_hours == 2.51  # 2 h 30 min 18 s
    assert dict(clean_requests(df).dtypes)["closed_date"] == "timestamp_ntz"
