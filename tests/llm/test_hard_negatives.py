import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from reqlens.llm import hard_negatives as H
from tests.conftest import SF01
from tests.oracle_compare import compare, duckdb_connection

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow(rows, k=5):
    good = []
    for vec_id, e, label in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            good.append((vec_id, label, [math.floor(max(min(256 * x, 2.0**24), -(2.0**24))) for x in e]))
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, (anchor, label, v) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), o, own == label) for j, (o, own, w) in enumerate(good) if j != i]
        for s, p, _ in sorted((x for x in scored if x[2]), key=order)[:k]:
            far = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=order)[:k]
            out += [(anchor, p, rank, n, s, t) for rank, (t, n, _) in enumerate(far, 1)]
    return sorted(out, key=str)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "v", "code", "tops", "anchor", "s", "p")})
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 100 == 0).collect()), key=str)


def vectors(n, dims, labels, spread, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    own = rng.integers(0, labels, n)
    x = centres[rng.integers(0, labels, n)] + spread * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i * 10, x[i].tolist(), int(own[i])) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 5.0])
def test_matches_brute_force_over_many_tiles(spark, monkeypatch, spread):
    monkeypatch.setattr(H, "ANCHORS", 7)
    monkeypatch.setattr(H, "ROWS", 40)
    rows = vectors(300, 20, 4, spread)
    rows += [(10_000 + k, rows[0][1], k % 2) for k in range(150)]  # a third are one vector
    assert mined(spark, rows) == slow(rows)


def test_awkward_rows(spark):
    rows = vectors(40, 3, 2, 1.0)
    rows += [rows[0], rows[0], rows[10]]  # repeated rows, anchors among them
    rows += [(None, [0.5, 0.5, 0.5], 0), (None, [0.5, 0.5, 0.5], 1), (200, None, 1), (300, [1.0, 1.0, 1.0], None)]
    rows += [(400, [float("nan"), 1.0, 0.0], 1), (500, [float("inf"), 0.0, 1.0], 1), (600, [None, 0.0, 1.0], 1)]
    rows += [(700, [], 0), (800, [0.25], 1), (900, [0.1, 0.2, 0.3, 0.4], 1), (1000, [1e30, -1e30, 0.0], 0), (1001, [1e30, -1e29, 0.0], 1)]
    rows += [(1100, [0.0, 0.0, 0.0], 7)]  # alone with its label
    assert mined(spark, rows) == slow(rows)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None), (None, None, None)]) == []
    assert mined(spark, [(1, [1.0], 1)]) == []  # no anchor


def test_scores_never_leave_their_intervals():
    rng = np.random.default_rng(1)
    for dims in (1, 3, 64, 100):
        v = np.floor(256 * np.concatenate([rng.normal(size=(50, dims)), np.zeros((1, dims)), np.eye(dims)[:1] * 1000]))
        low, high = H.intervals(v, H.encode(v))
        exact = H.scores(v.astype(np.int64), v.astype(np.int64))
        assert (low <= exact).all() and (exact <= high).all()


def test_clustered_vectors_are_pruned():
    rng = np.random.default_rng(2)
    base = H.rotated(np.where(rng.normal(size=(2, 64)) > 0, 1.0, -1.0) * 32)
    v = np.concatenate([base[:1] + rng.normal(size=(500, 64)), -base[:1] + rng.normal(size=(500, 64))])
    low, high = H.intervals(v[:1], H.encode(v))
    assert (high[0] >= H.kth(low, 5)[0]).mean() < 0.75  # the other cluster is out


def test_long_vectors_have_few_rows_in_a_tile(spark):
    rows = vectors(60, 5000, 2, 1.0)
    assert mined(spark, rows) == slow(rows)


def test_query_matches_sql(spark):
    name = "op12_hard_negatives"
    assert compare(queries()[name](spark, SF01), duckdb_connection(SF01), oracle_sql()[name]) == []
