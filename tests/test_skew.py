"""A hot key holding a third of all rows: AQE splits it in the join, aggregates stay exact."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from reqlens.plans import analyses as A
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests


def _write_tables(spark, root: str, n: int = 6000) -> None:
    base = dt.datetime(2024, 1, 1)
    events = [
        (i, base + dt.timedelta(minutes=7 * i), 7 if i % 3 == 0 else 100 + i % 50, ["click", "view"][i % 2],
         float(i % 40), f'{{"k": {i % 100}}}')
        for i in range(n)
    ]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).repartition(8).write.parquet(f"{root}/events.parquet")
    spark.createDataFrame(
        [(c, f"Customer#{c}", c % 25, 0.0, "X") for c in [7] + list(range(100, 150))],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    ).write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(k, f"N{k}", k % 5) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(k, f"R{k}") for k in range(5)], "r_regionkey int, r_name string") \
        .write.parquet(f"{root}/region.parquet")


def test_hot_user_is_split_and_results_exact(spark, tmp_path):
    root = str(tmp_path)
    _write_tables(spark, root)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        raw = raw_requests(spark, root)
        counted = raw.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
        rows = counted.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            counted.explain()
        plan = buf.getvalue().split("+- == Initial Plan ==")[0]
        assert "SortMergeJoin" in plan and "skew=true" in plan  # the hot user's partition was split
        assert "isFinalPlan=true" in plan
        got = {r.address: r.n for r in rows}
        assert got["Customer#7"] == 2000 + 10  # a third of 6000 events, plus 5 + 5 duplicated copies (ids 7, 9 mod 400)
        assert sum(got.values()) == raw.count()
        t = transform_requests(clean_requests(raw, spelling=CATEGORY_SPELLING))
        assert A.total_rows(t).first().total_rows == raw.count()
        assert sum(r.num_complaints for r in A.top_categories_by_region(t, top_n=100).collect()) == (
            t.where(F.col("borough") != "Unspecified").count())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
