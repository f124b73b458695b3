"""Hard-negative mining over rotated one-bit codes.

1. **Index.**  Each vector's components become integers.  Every row is rotated (random
   signs and Walsh-Hadamard transforms, which need no stored matrix and come out alike on
   every machine) and keeps the signs as a packed code, its *alignment* (the inner product
   of the rotated vector with the unit code vector) and the norm of the residual beside it.
   The index is written in the shared folder.
2. **Intervals.**  A query's rotated components are cut into eight bit planes, so its inner
   product with a code is eight popcounts.  The vector is alignment * code + residual, with the
   residual orthogonal to the code; so by Cauchy-Schwarz the true score lies within
   residual * sqrt(|q|^2 - <q, code>^2) of the estimate, plus the planes' rounding.  This is
   no probability: a score is never outside its interval.
3. **Candidates.**  The k-th best lower end bounds the k-th best score; rows whose upper end
   lies below it are out, and for negatives also rows whose interval misses the asked share
   of the positive's score.  All that survive are scored in integers, so results are exact,
   whatever the vectors.  (On unrelated directions a one-bit code says little and most
   intervals survive; on clustered vectors few do.)

Anchors meet rows in tiles of bounded size: blocks of anchors times blocks of rows, dealt by
a hash of the row, so no label, id or vector makes a large tile.  A tile gives at most k rows
for each question; Spark ranks those of all tiles.  Work grows with anchors times rows.

Defined cases: rows with a NULL label, a NULL vector or a NULL or non-finite component take
no part; a vector shorter than the longest counts as padded with zeros; components
saturate at +-2^24 as integers; repeated rows are rows of their own, and an anchor's other
rows include its copies; a NULL vec_id sorts last and is no anchor; an anchor without another
row of its label gives no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqlens.llm.common import NO_ID, load, staged

SCALE = 256.0
MOST = 2.0**24
ANCHORS = 2048  # of a tile
ROWS = 4096
CELLS = 1 << 20  # numbers of a tile's rows; fewer rows where vectors are long
CHUNK = 256  # anchors compared at once
PLANES = 8
K = 5

INDEX = "key long, vec_id long, label long, v binary, code binary, align double, resid double"


def _signs(n: int, seed: int) -> np.ndarray:
    """n signs, from a multiplicative hash of their places."""
    x = (np.arange(n, dtype=np.uint64) + np.uint64(1 + seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.where(x >> np.uint64(63), 1.0, -1.0)


def rotated(v: np.ndarray, seed: int = 42) -> np.ndarray:
    """Rows of v, zero-padded to a power of two (64 at least), under one fixed rotation."""
    width = max(64, 1 << (max(v.shape[1], 1) - 1).bit_length())
    out = np.zeros((len(v), width))
    out[:, : v.shape[1]] = v
    for turn in range(3):
        out *= _signs(width, seed + turn)
        step = 1
        while step < width:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class Codes(NamedTuple):
    words: np.ndarray
    align: np.ndarray
    resid: np.ndarray


def encode(v: np.ndarray) -> Codes:
    r = rotated(v)
    align = np.abs(r).sum(1) / np.sqrt(r.shape[1])
    return Codes(packed(r >= 0), align, np.sqrt(np.maximum((r * r).sum(1) - align**2, 0)))


def intervals(q: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the inner products of queries (rows of q) with coded vectors."""
    r = rotated(q)
    width = r.shape[1]
    low = r.min(1)
    step = (r.max(1) - low) / (2**PLANES - 1)
    cut = np.rint((r - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.uint8)
    near = low[:, None] + step[:, None] * cut
    inside = np.zeros((len(q), len(codes.words)))
    for p in range(PLANES):
        plane = packed((cut >> p) & 1)
        for w in range(plane.shape[1]):
            inside += np.bitwise_count(plane[:, w, None] & codes.words[None, :, w]) * float(1 << p)
    ones = np.bitwise_count(codes.words).sum(1)
    along = (2 * (low[:, None] * ones + step[:, None] * inside) - near.sum(1)[:, None]) / np.sqrt(width)
    off = np.abs(r - near).sum(1)[:, None] / np.sqrt(width)
    norm = (r * r).sum(1)[:, None]
    half = codes.resid * np.sqrt(np.maximum(norm - np.maximum(np.abs(along) - off, 0) ** 2, 0)) + codes.align * off
    half += 1e-9 * np.sqrt(norm) * (codes.align + codes.resid) + 1e-6  # rounding of doubles
    mid = codes.align * along
    return mid - half, mid + half


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products: by float64 products where all sums are exact there (below 2^53), else in int64."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def best(score: np.ndarray, ok: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the k highest scores of each row among ``ok``; ties by id, then key."""
    low = kth(np.where(ok, score, -np.inf), k)
    i, j = np.nonzero(ok & (score >= low[:, None]))
    order = np.lexsort((keys[j], ids[j], -score[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k]


class Side(NamedTuple):
    key: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    v: np.ndarray
    codes: Codes
    tops: np.ndarray

    def take(self, at) -> Side:
        c = self.codes
        return Side(self.key[at], self.ids[at], self.label[at], self.v[at], Codes(c.words[at], c.align[at], c.resid[at]), self.tops[at])


def _side(table: pa.Table, dims: int, anchors: bool, k: int) -> Side:
    t = table.filter(pc.equal(table["anchor"], anchors))
    n = len(t)
    packed_as = lambda name, kind: np.frombuffer(b"".join(t[name].to_pylist()), kind).reshape(n, -1 if n else 1)
    number = lambda name: t[name].to_numpy()
    tops = np.full((n, k), -np.inf)
    for i, found in enumerate(t["tops"].to_pylist()):
        tops[i, : len(found or [])] = found or []
    codes = Codes(packed_as("code", np.uint64), number("align"), number("resid"))
    return Side(number("key"), t["vec_id"].fill_null(NO_ID).to_numpy(), number("label"), packed_as("v", "<i4")[:, :dims], codes, tops)


FOUND = "anchor_key long, rank int, key long, vec_id long, score long"


def _found(anchors: Side, rows: Side, rank: np.ndarray, i: np.ndarray, j: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    ids = rows.ids[j]
    return pa.record_batch(
        {
            "anchor_key": pa.array(anchors.key[i], pa.int64()),
            "rank": pa.array(np.full(len(i), rank), pa.int32()),
            "key": pa.array(rows.key[j], pa.int64()),
            "vec_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
            "score": pa.array(score, pa.int64()),
        }
    )


def _positives(anchors: Side, rows: Side, k: int):
    """Per anchor, the best k other rows of its label in this tile."""
    order = np.argsort(rows.label, kind="stable")
    rows = rows.take(order)
    for label in np.unique(anchors.label):
        own = slice(*np.searchsorted(rows.label, [label, label + 1]))
        a, r = anchors.take(anchors.label == label), rows.take(own)
        if not len(r.key):
            continue
        for lo in range(0, len(a.key), CHUNK):
            part = a.take(slice(lo, lo + CHUNK))
            low, high = intervals(part.v, r.codes)
            other = part.key[:, None] != r.key
            alive = other & (high >= kth(np.where(other, low, -np.inf), k)[:, None])
            some = alive.any(0)
            left = r.take(some)
            score = scores(part.v, left.v)
            i, j = best(score, alive[:, some], left.ids, left.key, k)
            yield _found(part, left, 0, i, j, score[i, j])


def _negatives(anchors: Side, rows: Side, k: int, least: int):
    """Per anchor and positive, the best k rows of other labels in this tile from ``least`` percent of its score up to it."""
    for lo in range(0, len(anchors.key), CHUNK):
        part = anchors.take(slice(lo, lo + CHUNK))
        low, high = intervals(part.v, rows.codes)
        other = part.label[:, None] != rows.label
        alive = np.zeros(other.shape, bool)
        for p in range(k):
            top = part.tops[:, p, None]
            sure = kth(np.where(other & (high <= top), low, -np.inf), k)[:, None]
            alive |= other & (low <= top) & (high >= np.maximum(sure, least * top / 100 - 1))
        some = alive.any(0)
        left = rows.take(some)
        alive, score = alive[:, some], scores(part.v, left.v)
        for p in range(k):
            known = np.isfinite(part.tops[:, p])
            top = np.where(known, part.tops[:, p], 0).astype(np.int64)[:, None]
            ok = alive & known[:, None] & (score <= top) & (100 * score >= least * top)
            i, j = best(score, ok, left.ids, left.key, k)
            yield _found(part, left, p + 1, i, j, score[i, j])


class Index(NamedTuple):
    """Written index of all rows (INDEX), their number and the longest vector's length."""

    rows: DataFrame
    n: int
    dims: int


def index(vectors: DataFrame) -> Index:
    """Integers and codes of every row of ``vectors`` (vec_id, label, embedding) that takes part."""
    raw = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["label"].cast("long").alias("label"),
        vectors["embedding"].cast("array<double>").alias("e"),
    )
    finite = F.forall("e", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    integers = F.transform("e", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(MOST)), F.lit(-MOST))).cast("int"))
    good = raw.where(F.col("label").isNotNull() & F.col("e").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("key"), "vec_id", "label", integers.alias("e")
    )
    size = good.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("e")), F.lit(0)).alias("dims")).first()
    dims = max(int(size["dims"]), 1)

    def coded(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, step := max(1, (1 << 20) // dims)):
                part = batch.slice(lo, step)
                v = np.zeros((part.num_rows, dims), "<i4")
                for i, own in enumerate(part.column("e").to_pylist()):
                    v[i, : len(own)] = own
                c = encode(v)
                flat = lambda x: pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.record_batch(
                    [*(part.column(n) for n in ("key", "vec_id", "label")), flat(v), flat(c.words), pa.array(c.align), pa.array(c.resid)],
                    ["key", "vec_id", "label", "v", "code", "align", "resid"],
                )

    return Index(staged(good.mapInArrow(coded, INDEX)), size["n"], dims)


def _tiles(idx: Index, anchors: DataFrame, n_anchors: int, work) -> DataFrame:
    """``work(anchors, rows)`` on each tile of a block of anchors and a block of rows."""
    row_blocks = max(1, -(-idx.n // min(ROWS, max(64, CELLS // idx.dims))))
    anchor_blocks = max(1, -(-n_anchors // ANCHORS))
    dealt = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["key", "vec_id", "label", "v", "code", "align", "resid"]
    asked = anchors.select(*columns, "tops", F.lit(True).alias("anchor"), dealt(anchor_blocks).alias("s"), every(row_blocks).alias("p"))
    stored = idx.rows.select(
        *columns, F.lit(None).cast("array<long>").alias("tops"), F.lit(False).alias("anchor"), dealt(row_blocks).alias("p"), every(anchor_blocks).alias("s")
    )

    dims = idx.dims  # not the index, which tasks cannot hold

    def run(table: pa.Table) -> pa.Table:
        got = list(work(_side(table, dims, True, K), _side(table, dims, False, K)))
        kinds = [("anchor_key", pa.int64()), ("rank", pa.int32()), ("key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
        return pa.Table.from_batches(got, pa.schema(kinds)) if got else pa.schema(kinds).empty_table()

    return asked.unionByName(stored).groupBy("s", "p").applyInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k first of each group: higher scores, ties by smaller vec_id (NULL last)."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "key")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)


def mine(vectors: DataFrame, anchor: Column, least: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` picks the anchors among rows of ``vectors`` by vec_id and label.  Each anchor's positives are
    its K best other rows of one label; each one's negatives the K best rows of other labels
    that score from ``least`` percent of it up to all of it.
    """
    idx = index(vectors)
    anchors = idx.rows.where(anchor)
    n = anchors.count()
    no_tops = anchors.withColumn("tops", F.lit(None).cast("array<long>"))
    near = _tiles(idx, no_tops, n, lambda a, r: _positives(a, r, K))
    # staged: the negatives' tiles and the result both read them
    positives = staged(
        _ranked(near, K, "anchor_key").select(
            "anchor_key", F.col("at").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    tops = positives.groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("p", "positive_score"))).alias("tops"))
    asked = anchors.join(tops.select("anchor_key", F.col("tops.positive_score").alias("tops")), F.col("key") == F.col("anchor_key"))
    far = _tiles(idx, asked, n, lambda a, r: _negatives(a, r, K, least)).withColumnRenamed("rank", "p")
    kept = _ranked(far, K, "anchor_key", "p").select(
        "anchor_key", "p", F.col("at").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = anchors.select(F.col("key").alias("anchor_key"), F.col("vec_id").alias("anchor_id"))
    return kept.join(positives, ["anchor_key", "p"]).join(names, "anchor_key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
