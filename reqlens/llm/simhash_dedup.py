"""SimHash near-duplicate detection by tiled exact comparison.

Every whole text gets a 64-bit fingerprint: lower-cased A-Z, words
`[^\\x20\\x09-\\x0D]+`, shingles of ``shingle`` words joined by a space (repeats
count; a text of fewer words is one shingle; no words: fingerprint zero),
XXH64 with seed 42; a bit is set if over half the shingle hashes have it.
Fingerprints at ``radius`` or fewer differing bits are linked, and the
documents of a connected component carry its smallest doc_id.

Comparison is exact and tiled.  A tile holds the *distinct* fingerprints with
the same population counts in each of ``parts`` equal parts.  Two fingerprints
within the radius have part counts that differ by the radius at most in sum,
so all other tile pairs are skipped: with four parts and radius 2, 41 of up to
83,521 tiles stay for each tile.  The rest is compared with numpy exclusive-or
and bit counts.  Tiles over ``block`` fingerprints are cut by hash, so one task
gets two blocks at most, whatever the data.  A task returns a spanning forest
of the links it found (never all pairs of a group), and the components of
those links are found on Spark.

``parts`` (a divisor of 64) trades rows for pairs: compared pairs grow with the
square of the distinct fingerprints, divided by about 60 (4 parts) or 2,700
(8 parts), against 21 or 73 copies of each 8-byte fingerprint.

Defined cases: a NULL or blank text has fingerprint zero, linked like any
other; every input row is returned, repeated rows too; a NULL doc_id never
names a component unless all ids in it are NULL; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import chunks, documents, load, staged
from reqlens.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = 4
#: Fingerprints of one side of a comparison task, and the rows compared at once inside it.
BLOCK = 16_384
ROWS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # both of ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = [0, *ends[:-shingle].tolist()]
    last = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(first, last, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = b.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "fp": pa.array(prints)})

    return run


def _tile(parts: int) -> Column:
    """The parts' population counts, as the digits of one number to base 128."""
    bits = 64 // parts
    mask = F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")
    tile = F.lit(0).cast("long")
    for k in range(parts):
        tile = tile * 128 + F.bit_count(F.shiftrightunsigned("fp", k * bits).bitwiseAND(mask)).cast("long")
    return tile


def _offsets(parts: int, radius: int) -> list[int]:
    """Differences of tile numbers that links can span: count differences of ``radius`` at most in sum; half of the pairs."""
    found = set()
    for steps in itertools.product(range(-radius, radius + 1), repeat=parts) if parts <= 4 else _sparse(parts, radius):
        if sum(map(abs, steps)) <= radius:
            n = 0
            for s in steps:
                n = n * 128 + s
            found.add(n)
    return sorted(n for n in found if n >= 0)


def _sparse(parts: int, radius: int) -> Iterator[tuple[int, ...]]:
    for where in itertools.combinations_with_replacement(range(parts), radius):
        for signs in itertools.product((-1, 0, 1), repeat=radius):
            steps = [0] * parts
            for at, s in zip(where, signs, strict=True):
                steps[at] += s
            yield tuple(steps)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links a[i]-b[i] between n nodes: each node with its component's least one."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            node = np.flatnonzero(root != np.arange(n))
            return node, root[node]
        root = new


def near(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two sets of fingerprints, as a spanning forest over left followed by right."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = 0
    for lo in range(0, len(left), ROWS):
        i, j = np.nonzero(np.bitwise_count(left[lo : lo + ROWS, None] ^ right[None, :]) <= radius)
        a.append(i + lo)
        b.append(j + len(left))
        held += len(i)
        if held > 1 << 20:  # links so far, contracted
            x, y = forest(np.concatenate(a), np.concatenate(b), len(left) + len(right))
            a, b, held = [x], [y], len(x)
    return forest(np.concatenate(a), np.concatenate(b), len(left) + len(right))


def _compare(radius: int):
    def run(table: pa.Table) -> pa.Table:
        prints = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy()
        left, right = np.sort(prints[home == 1]), np.sort(prints[home == 0])
        same = table.column("same")[0].as_py()
        if same:  # a block against itself
            right = left
        both = np.concatenate([left, right]).view(np.int64)
        x, y = near(left, right, radius) if len(left) and len(right) else (np.zeros(0, np.int64),) * 2
        keep = both[x] != both[y]
        return pa.table({"a": pa.array(both[x][keep]), "b": pa.array(both[y][keep])})

    return run


def links(prints: DataFrame, radius: int = RADIUS, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """a, b: fingerprints whose links connect all that lie within ``radius`` bits, from distinct ones (fp)."""
    tiled = prints.select("fp", _tile(parts).alias("tile"))
    # one row per tile that exists: at most (64 / parts + 1) ** parts, and no more than fingerprints
    counts = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cuts"))
    with_cuts = tiled.join(counts, "tile").withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
    pairs = counts.select(
        F.col("tile").alias("home_tile"),
        F.col("cuts").alias("home_cuts"),
        F.explode(F.array([F.lit(n).cast("long") + F.col("tile") for n in _offsets(parts, radius)])).alias("tile"),
    ).join(counts.withColumnRenamed("cuts", "away_cuts"), "tile").select(
        "home_tile", "home_cuts", F.col("tile").alias("away_tile"), "away_cuts"
    )
    # home blocks meet each block of the other tile; in one tile, blocks i <= j
    home = with_cuts.join(pairs, with_cuts["tile"] == pairs["home_tile"]).select(
        "fp", "home_tile", "away_tile", F.col("cut").alias("i"),
        F.explode(F.sequence(F.when(F.col("home_tile") == F.col("away_tile"), F.col("cut")).otherwise(0), F.col("away_cuts") - 1)).alias("j"),
        F.lit(1).alias("home"),
    )
    away = with_cuts.join(pairs, with_cuts["tile"] == pairs["away_tile"]).select(
        "fp", "home_tile", "away_tile",
        F.explode(F.sequence(F.lit(0), F.when(F.col("home_tile") == F.col("away_tile"), F.col("cut")).otherwise(F.col("home_cuts") - 1))).alias("i"),
        F.col("cut").alias("j"),
        F.lit(0).alias("home"),
    ).where("home_tile != away_tile OR i != j")
    same = (F.col("home_tile") == F.col("away_tile")) & (F.col("i") == F.col("j"))
    met = home.unionByName(away).withColumn("same", same)
    return met.groupBy("home_tile", "away_tile", "i", "j").applyInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """doc_id, fp (long), component_id of every row."""
    # staged: the comparison, its rounds and the result all read the fingerprints
    rows = staged(documents(docs).mapInArrow(_fingerprints(shingle), "doc_id long, fp long"))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = components(links(classes.select("fp"), radius, parts, block))
    # a component is named by its smallest doc_id, not by a fingerprint
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = near_duplicates(load(spark, sf_dir, "documents"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
