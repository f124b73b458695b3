import random

import pytest
from pyspark.sql import functions as F

from reqlens.operators.clean import clean_requests
from reqlens.operators.gates import check_cleaning
from reqlens.operators.ranking import bucket, value_ranks
from reqlens.operators.spelling import apply_spelling, spelling_map, spelling_review
from reqlens.plans.analyses import handler_workload_speed
from reqlens.sources.files import read_raw_csv
from tests.fixtures import write_raw_csv


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_match_a_sort(spark, descending):
    rng = random.Random(8)
    values = [rng.choice([rng.randint(-40, 40), rng.randint(-(2**62), 2**62), 2**63 - 1, -(2**63), 7, None]) for _ in range(500)]
    df = spark.createDataFrame([(v, i % 9) for i, v in enumerate(values)], "v long, w int")
    ranks = value_ranks(df, {"v": descending, "w": not descending}).collect()
    for column, known, down in (("v", [v for v in values if v is not None], descending), ("w", [i % 9 for i in range(500)], not descending)):
        known.sort(reverse=down)
        assert {r.value: r["rank"] for r in ranks if r.column == column} == {v: known.index(v) + 1 for v in known}
    assert value_ranks(spark.createDataFrame([], "v long"), {"v": True}).count() == 0


def test_buckets_never_fall(spark):
    rng = random.Random(2)
    values = sorted({rng.randint(-(2**k), 2**k) for k in range(63) for _ in range(8)} | {-(2**63), 2**63 - 1, 0})
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v long").select("i", bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got) and len(set(got)) <= 4096


def test_handlers_are_never_in_one_task(spark):
    """Only the buckets' sizes, of bounded number, go to one task; a window over all handlers would."""
    per = spark.range(1000).select(F.concat(F.lit("h"), F.col("id") % 97).alias("agency"), (F.col("id") % 13 / 4).cast("double").alias("resolution_time_hours"))
    df = handler_workload_speed(per)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    single = [line for line in final.splitlines() if "SinglePartition" in line]
    windows = [line for line in final.splitlines() if " Window " in line or "Window [" in line]
    assert windows and all("_b#" in line for line in windows)
    assert len(single) <= 2  # the sizes of the buckets, once for either rank


def test_derived_spelling_and_its_gate(spark, tmp_path):
    raw = read_raw_csv(spark, write_raw_csv(str(tmp_path)))
    review = spelling_review(raw)
    derived = spelling_map(review)
    assert derived == {"ELEVATOR": "Elevator", "PLUMBING": "Plumbing"}  # ties go to the one that is not all capitals
    cleaned = clean_requests(raw, spelling=derived)
    assert check_cleaning(cleaned, spelling=derived)["row_count"] == raw.count()
    with pytest.raises(ValueError):  # the gate holds the layer to the derived map
        check_cleaning(clean_requests(raw, spelling={}), spelling=derived)
    same = lambda df: sorted(df.select("unique_key", "complaint_type").collect(), key=repr)
    fixed = clean_requests(apply_spelling(raw, review), spelling={})
    assert same(fixed) == same(cleaned) and apply_spelling(raw, review).columns == raw.columns


def test_the_commonest_spelling_wins(spark):
    rows = [("NOISE",)] * 3 + [("Noise",)] * 2 + [(" noise ",)] + [("a",), ("A",), ("b",), (None,), ("  ",), ("é",), ("É",), ("É",)]
    df = spark.createDataFrame(rows, "complaint_type string")
    got = {r.complaint_variant: (r.proposed_spelling, r.replaced, r.variant_share) for r in spelling_review(df).collect()}
    assert got["Noise"] == ("NOISE", True, 33.33) and got["NOISE"] == ("NOISE", False, 50.0) and got[" noise "][0] == "NOISE"
    assert got["A"] == ("a", True, 50.0) and got["é"][0] == "É" and "b" not in got
    with pytest.raises(ValueError):
        spelling_map(spelling_review(df), most=1)
    assert spelling_review(df.limit(0)).count() == 0
