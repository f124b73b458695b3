from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from reqlens.functions import (
    half_up_div,
    hour_label,
    hours_hundredths,
    parse_timestamp,
    share_pct,
    signed_pct_change,
    whole_seconds_between,
)


def _half_up(num: int, den: int) -> int:
    return int((Decimal(num) / Decimal(den)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def test_half_up_div_matches_decimal(spark):
    pairs = [(n, d) for n in range(-60, 61, 7) for d in (1, 2, 3, 7, 36, 72)] + [(18, 36), (-18, 36), (5, 0)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r.n, r.d): r.q for r in df.select("n", "d", half_up_div("n", "d").alias("q")).collect()}
    for n, d in pairs:
        assert got[(n, d)] == (None if d == 0 else _half_up(n, d)), (n, d)


def test_hours_rounding_ties(spark):
    secs = [0, 17, 18, 35, 36, 54, 3600, 3618, 9000, 86399]
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    got = [r.h for r in df.select(hours_hundredths(F.col("s")).alias("h")).orderBy("s").collect()]
    assert got == [_half_up(s * 100, 3600) for s in secs]
    assert got[2] == 1  # 18 s -> 0.01 h


def test_share_and_signed_change(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5)], "a long, b long")
    got = [r.p for r in df.select(share_pct("a", "b").alias("p")).collect()]
    assert got == [33.33, 66.67, 12.5, 0.0]
    # avg 10.00 (1000 hundredths): 15 -> +50%, 5 -> -50%; avg 3.33: 5 -> +50.15
    df2 = spark.createDataFrame([(15, 1000), (5, 1000), (5, 333), (1, 0)], "c long, a long")
    got2 = [r.p for r in df2.select(signed_pct_change("c", "a").alias("p")).collect()]
    assert got2 == [50.0, -50.0, 50.15, None]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_parse_timestamp(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        texts = ["01/02/2026 01:04:05 PM", "1/2/2026 1:04:05 PM", "", "not a date", None,
                 "12/31/2025 12:00:00 AM", "03/08/2026 02:30:00 AM"]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        out = df.select(parse_timestamp(F.col("t")).alias("p"))
        assert dict(out.dtypes)["p"] == "timestamp_ntz"
        got = [None if r.p is None else r.p.isoformat(sep=" ") for r in out.collect()]
        assert got == ["2026-01-02 13:04:05", None, None, None, None, "2025-12-31 00:00:00",
                       "2026-03-08 02:30:00"]  # DST-gap wall time kept as is
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_whole_seconds_and_label(spark):
    df = spark.createDataFrame(
        [("2026-01-01 00:00:00.900", "2026-01-01 00:00:01.100", 3), (None, "2026-01-01 00:00:00", None)],
        "a string, b string, h int",
    ).select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"), "h")
    rows = df.select(whole_seconds_between("a", "b").alias("s"), hour_label(F.col("h")).alias("l")).collect()
    assert rows[0].s == 1 and rows[0].l == "03:00"
    assert rows[1].s is None and rows[1].l is None


def test_half_up_div_property(spark):
    """Random integers (both signs, large magnitudes) against Decimal HALF_UP."""
    import random

    rng = random.Random(7)
    pairs = [(rng.randint(-10**12, 10**12), rng.randint(1, 10**7)) for _ in range(3000)]
    pairs += [(d * k + d // 2, d) for d, k in ((2, 5), (36, 100), (1000, -3))]  # exact halves
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r.n, r.d): r.q for r in df.select("n", "d", half_up_div("n", "d").alias("q")).collect()}
    for n, d in pairs:
        assert got[(n, d)] == _half_up(n, d), (n, d)


def test_fixed_zone_fast_path_equals_guarded(spark):
    texts = [f"{m:02d}/{d:02d}/2026 {h:02d}:{mi:02d}:07 {ap}" for m in (1, 3, 11) for d in (1, 8, 31)
             for h in (12, 1, 2, 11) for mi in (0, 30) for ap in ("AM", "PM")] + ["bad", None, "13/01/2026 01:00:00 AM"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    fast = df.select(parse_timestamp(F.col("t"), session_zone="UTC").alias("p"))
    guarded = df.select(parse_timestamp(F.col("t")).alias("p"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert fast.collect() == guarded.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_format_raw_timestamp_round_trip(spark, tz):
    from reqlens.functions import format_raw_timestamp

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        vals = ["2026-03-08 02:30:00", "2024-01-01 00:00:07.179575", "2024-01-01 12:59:59", "2024-12-31 23:00:00", None]
        df = spark.createDataFrame([(v,) for v in vals], "a string").select(F.col("a").cast("timestamp_ntz").alias("t"))
        out = df.select(format_raw_timestamp(F.col("t"), tz).alias("x")).collect()
        assert [r.x for r in out] == ["03/08/2026 02:30:00 AM", "01/01/2024 12:00:07 AM", "01/01/2024 12:59:59 PM",
                                      "12/31/2024 11:00:00 PM", None]
        back = df.select(format_raw_timestamp(F.col("t"), tz).alias("x")).select(parse_timestamp(F.col("x"), session_zone=tz).alias("p"))
        got = [r.p for r in back.collect()]
        want = [None if r.t is None else r.t.replace(microsecond=0) for r in df.collect()]
        assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
