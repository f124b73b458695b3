"""Randomised inputs (few values, many ties, NULLs everywhere) against the brute-force analyses."""

import datetime as dt
import random

import pytest

import tests.brute as B
from reqlens.plans import analyses as A

SCHEMA = (
    "unique_key long, complaint_type string, borough string, agency string, request_date date, "
    "request_day_of_week string, request_hour int, resolution_time_hours double"
)


def _rows(seed: int, n: int = 400):
    rng = random.Random(seed)
    cats = ["a", "b", "c", "d", "e", None, "  "]
    boroughs = ["X", "Y", "Z", "Unspecified", None]
    days = [dt.date(2026, 1, d) for d in range(1, 12)] + [None]
    rows = []
    for i in range(n):
        day = rng.choice(days)
        hours = None if rng.random() < 0.3 else rng.randint(0, 5000) / 100
        rows.append((
            i,
            rng.choice(cats[: rng.randint(2, len(cats))]),
            rng.choice(boroughs),
            rng.choice(["h1", "h2", "h3", None]),
            day,
            day.strftime("%A") if day else None,
            None if day is None else rng.choice([None, 0, 1, 2, 3, 23]),
            hours,
        ))
    return rows


@pytest.fixture(scope="module", params=[1, 2, 3, 4])
def data(spark, request):
    rows = _rows(request.param)
    df = spark.createDataFrame(rows, SCHEMA).cache()
    return df, [r.asDict() for r in df.collect()]


def _t(df):
    return {tuple(r) for r in df.collect()}


def test_random_q1_q4(data):
    df, rows = data
    assert _t(A.top_categories_by_region(df)) == B.top_complaints_by_borough(rows)
    assert _t(A.high_volume_categories(df)) == B.high_volume_complaints(rows)
    assert _t(A.handler_workload_speed(df)) == B.agency_workload_speed(rows)
    assert _t(A.region_coverage(df)) == B.borough_coverage(rows)


def test_random_q5_q7(data):
    df, rows = data
    assert _t(A.peak_hours(df)) == B.peak_hours(rows)
    assert _t(A.weekday_pattern(df)) == B.weekday_pattern(rows)
    assert _t(A.daily_spikes(df)) == B.daily_spikes(rows)


@pytest.mark.parametrize("top_n, extra", [(10, 3), (2, 1), (1, 2)])
def test_random_q8_q9(data, top_n, extra):
    df, rows = data
    assert _t(A.peak_hour_by_category(df, top_n=top_n, top_hours=extra)) == B.peak_hour_by_complaint(rows, top_n, extra)
    assert (_t(A.category_resolution_by_region(df, top_n=top_n, min_resolved=extra))
            == B.complaint_resolution_by_borough(rows, top_n, extra))
