import random

import numpy as np
import pytest
import xxhash

from reqlens.llm import simhash_dedup as S
from reqlens.llm.components import components
from tests.llm.fixtures import awkward_rows, documents, texts, vocabulary


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if shingles and 2 * counts[b] > len(shingles))


def classes(prints, radius):
    """Least index reachable over links, for each of a list of (id, fingerprint)."""
    low = list(range(len(prints)))
    while True:
        new = [min(low[j] for j, q in enumerate(prints) if bin(p ^ q).count("1") <= radius) for p in prints]
        if new == low:
            return low
        low = [min(low[i], new[i], low[new[i]]) for i in range(len(low))]


def named(rows, radius):
    prints = [slow_fingerprint(t) for _, t in rows]
    of = classes(prints, radius)
    least = {}
    for (d, _), c in zip(rows, of, strict=True):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return sorted(((d, f, least.get(c)) for (d, _), f, c in zip(rows, prints, of, strict=True)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocab = vocabulary(200)
    rows = []
    for d, text in enumerate(texts(60, 120, vocab)):
        rows.append((d, text))
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 - d, " ".join(words).upper()))
    rows += [(2000 + k, rows[0][1]) for k in range(60)]  # a third are copies
    df = documents(spark, [(d, t, None, None, None) for d, t in rows], clashes=True)
    assert result(S.near_duplicates(df)) == named(rows, 2)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    df = documents(spark, awkward_rows(), clashes=True)
    assert result(S.near_duplicates(df)) == named(rows, 2)
    assert S.near_duplicates(documents(spark, [])).count() == 0
    only = S.near_duplicates(documents(spark, [(None, "a b", None, None, None)])).collect()
    assert [r.component_id for r in only] == [None]


@pytest.mark.parametrize(("parts", "block"), [(4, 16_384), (4, 5), (8, 7)])
def test_links_connect_all_within_radius(spark, parts, block):
    """Planted near fingerprints, over tiles cut into small blocks, against all pairs."""
    rng = random.Random(block)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(15)} | set(centres))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    root = {r.node % 2**64: r.root for r in components(S.links(df, 2, parts, block)).collect()}
    of = classes(prints, 2)
    got = [root.get(p, int(np.uint64(p).astype(np.int64))) for p in prints]
    assert len(set(got)) == len(set(of))
    assert len({(a, b) for a, b in zip(got, of, strict=True)}) == len(set(of))


def test_forest_never_returns_all_pairs():
    prints = np.array([1 << b for b in range(64)], np.uint64)  # all within two bits of each other
    a, b = S.near(prints, prints, 2)
    assert len(a) == 127 and set(b.tolist()) == {0}


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
