import pytest
from pyspark.sql import functions as F

from reqlens.operators import quality as Q
from reqlens.roles import DEFAULT_ROLES
from reqlens.sources.files import read_raw_csv
from tests.fixtures import ROW_COUNT, write_raw_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_raw_csv(spark, write_raw_csv(str(tmp_path_factory.mktemp("csv"))))


def _pairs(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_structure_and_dates(raw):
    r = Q.structure_profile(raw).first()
    assert (r.row_count, r.column_count) == (ROW_COUNT, 24)
    d = Q.date_range(raw).first()
    assert str(d.earliest_date) == "2026-01-05 10:00:00" and str(d.latest_date) == "2026-01-14 11:00:00"
    assert d.unparseable_dates == 2


def test_missing_profile(raw):
    prof = {r.column_name: (r.missing_count, r.missing_percentage) for r in Q.missing_profile(raw).collect()}
    assert prof["complaint_type"] == (2, round(2 * 100 / ROW_COUNT, 2))  # '  ' and NULL
    assert prof["agency"][0] == 1
    assert prof["latitude"][0] == 3 and prof["longitude"][0] == 2
    assert prof["location"] == (ROW_COUNT, 100.0)
    core = Q.core_completeness(raw)
    assert [r.column_name for r in core.collect()] == ["unique_key", "created_date", "agency", "complaint_type",
                                                        "status", "borough"]


def test_missing_profile_empty_table(raw):
    prof = Q.missing_profile(raw.limit(0)).collect()
    assert all(r.missing_count == 0 and r.missing_percentage is None for r in prof)


def test_placeholders(raw):
    counts = {(r.column_name, r.placeholder_value): r.placeholder_count for r in Q.placeholder_counts(raw).collect()}
    assert counts == {("detail", "N/A"): 1, ("detail", "NA"): 1, ("detail", "NULL"): 1,
                      ("additional_details", "None"): 1, ("additional_details", "NaN"): 1}
    totals = _pairs(Q.placeholder_totals(raw), "column_name", "total_placeholders")
    assert totals == {"detail": 3, "additional_details": 2, "facility_type": 0, "resolution_description": 0,
                      "park_facility_name": 0}


def test_duplicates(raw):
    assert Q.full_row_duplicates(raw).first().duplicate_rows == 1
    assert Q.duplicate_keys(raw).first().duplicate_keys == 2


def test_duplicates_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), (None, None), (None, None)], "x string, y string")
    assert Q.full_row_duplicates(df).first().duplicate_rows == 2


def test_status_checks(raw):
    assert _pairs(Q.status_counts(raw), "status", "request_count") == {
        "Closed": 15, "Pending": 1, "Open": 1, "Assigned": 1, None: 1}
    assert _pairs(Q.missing_closed_by_status(raw), "status", "missing_closed_count") == {
        "Closed": 1, "Open": 1, "Assigned": 1}
    assert [r.unique_key for r in Q.closed_missing_closed_date(raw).collect()] == [4]
    assert [r.unique_key for r in Q.non_closed_with_closed_date(raw).collect()] == [5]  # NULL status excluded
    assert _pairs(Q.non_closed_closed_by_status(raw), "status", "request_count") == {"Pending": 1}


def test_invalid_dates(raw):
    assert [r.unique_key for r in Q.invalid_date_rows(raw).collect()] == [6]
    assert _pairs(Q.invalid_date_by_status(raw), "status", "request_count") == {"Closed": 1}
    assert Q.invalid_date_matching_resolution(raw).first().matching_rows == 1
    assert "resolution_updated" in Q.invalid_date_details(raw).columns


def test_geography(raw):
    boroughs = _pairs(Q.region_counts(raw), "borough", "request_count")
    assert boroughs["Unspecified"] == 1 and boroughs[None] == 1
    assert Q.missing_zip_count(raw).first().missing_zip_count == 2
    assert _pairs(Q.missing_zip_by_region(raw), "borough", "missing_zip_count") == {"EAST": 1, "Unspecified": 1}
    assert Q.unspecified_region_rows(raw).columns == ["incident_zip", "city", "address", "latitude", "longitude",
                                                      "location"]
    assert _pairs(Q.missing_coords_by_region(raw), "borough", "request_count") == {"WEST": 1, "Unspecified": 1}
    assert sorted(r.unique_key for r in Q.missing_coord_rows(raw).collect()) == [10, 11]
    assert [r.unique_key for r in Q.coord_mismatch_rows(raw).collect()] == [9]


def test_categories_and_handlers(raw):
    assert Q.distinct_categories(raw).first().distinct_complaint_count == 9
    assert sorted(r.unique_key for r in Q.blank_categories(raw).collect()) == [16, 17]
    assert Q.distinct_handlers(raw).first().distinct_agency_count == 5
    assert [r.unique_key for r in Q.blank_handlers(raw).collect()] == [16]
    names = [(r.agency, r.agency_name, r.distinct_agency_names) for r in Q.handler_name_consistency(raw).collect()]
    assert names == [("TRN", "TRN (old name)", 2), ("TRN", "Transportation", 2)]
    variants = {(r.normalized_complaint, r.complaint_variant) for r in Q.category_case_variants(raw).collect()}
    assert variants == {("elevator", "ELEVATOR"), ("elevator", "Elevator"), ("plumbing", "PLUMBING"),
                        ("plumbing", "Plumbing")}
    ranking = Q.category_ranking(raw).collect()
    assert ranking[0].request_count >= ranking[-1].request_count


def test_quality_counts_fused(raw):
    r = Q.quality_counts(raw).first()
    assert r.row_count == ROW_COUNT and r.closed_without_closed_date == 1 and r.open_with_closed_date == 1
    assert r.created_after_closed == 1 and r.missing_coordinates == 2 and r.coordinate_mismatches == 1


def test_duplicates_none(spark, raw):
    distinct = raw.dropDuplicates()
    assert Q.full_row_duplicates(distinct).first().duplicate_rows == 0


@pytest.mark.parametrize("width", [64, 130])
def test_duplicates_of_wide_null_rows(spark, width):
    """All-NULL columns in any number, and a third of the rows the same."""
    wide = spark.range(30).select("id", *[F.lit(None).cast("string").alias(f"c{i}") for i in range(width)])
    df = wide.withColumn("id", F.when(F.col("id") < 10, 0).otherwise(F.col("id")))
    assert Q.full_row_duplicates(df).first().duplicate_rows == 9


def test_duplicates_stay_lazy(spark, raw):
    """No job runs before an action."""
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "building only")
    try:
        Q.full_row_duplicates(raw)
        assert not sc.statusTracker().getJobIdsForGroup("lazy")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_seven_column_table(raw):
    """Absent optional columns count as NULL in every row; nothing crashes."""
    from reqlens.plans.pipeline import PROFILE_CHECKS

    small = raw.select(*DEFAULT_ROLES.required)
    for name, check in PROFILE_CHECKS.items():
        check(small).collect()
    assert Q.missing_zip_count(small).first().missing_zip_count == ROW_COUNT
    assert Q.missing_coord_rows(small).columns == Q.missing_coord_rows(raw).columns
    assert {r.total_placeholders for r in Q.placeholder_totals(small).collect()} == {0}


def test_unparseable_dates(raw):
    assert _pairs(Q.unparseable_dates(raw), "column_name", "unparseable_count") == {
        "created_date": 2, "closed_date": 0, "resolution_updated": 0}


def test_schema_profile(raw):
    rows = Q.schema_profile(raw).collect()
    assert [r.column_name for r in rows] == raw.columns
    assert {r.column_name: r.data_type for r in rows}["unique_key"] == "bigint"
    assert rows[0].column_position == 1
