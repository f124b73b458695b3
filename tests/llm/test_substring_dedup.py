import random

import numpy as np
import pytest

from reqlens.llm import substring_dedup as S
from tests.llm.fixtures import awkward_rows, documents, texts, vocabulary


def brute(rows, window):
    """doc_id -> words, and which of them a later occurrence of a window covers."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = (text or "").encode().split()
        covered = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                covered[i : i + window] = [True] * window
            seen.add(key)
        out[doc] = (words, covered)
    return out


def check(spark, rows, window, gram, **more):
    df = documents(spark, [(d, t, None, None, None) for d, t in rows], **more)
    got = {r.doc_id: r for r in S.remove_repeats(df, window, gram, n_shards=3).collect()}
    want = brute(rows, window)
    assert set(got) == set(want)
    for doc, (words, covered) in want.items():
        r = got[doc]
        assert (r.n_words, r.n_removed) == (len(words), sum(covered)), doc
        assert r.kept_text.encode().split() == [w for w, c in zip(words, covered, strict=True) if not c]
        assert [c for c in covered].count(True) == sum(s.end - s.start for s in r.removed)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = vocabulary(60, seed)
    passages = texts(6, 40, vocab, seed)
    rows = []
    for d in range(60):
        parts = texts(3, 20, vocab, seed * 100 + d) + rng.choices(passages, k=2) + ["ha " * rng.randint(0, 15)]
        rng.shuffle(parts)
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(parts)))
    # a third of the documents are copies of one
    rows += [(100 + d, rows[0][1]) for d in range(30)]
    check(spark, rows, 6, 3, clashes=True)


def brute_rows(rows, window):
    """(doc_id, n_words, kept words) of every row; rows that share an id, or have none, in their order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        words = (rows[i][1] or "").encode().split()
        covered = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                covered[at : at + window] = [True] * window
            seen.add(key)
        out.append((rows[i][0], len(words), b" ".join(w for w, c in zip(words, covered, strict=True) if not c).decode()))
    return sorted(out, key=repr)


def removed(spark, rows, window=20):
    full = [(*r, *[None] * (5 - len(r))) for r in rows]
    got = S.remove_repeats(documents(spark, full, clashes=True), window).collect()
    return sorted(((r.doc_id, r.n_words, r.kept_text) for r in got), key=repr)


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = removed(spark, rows)
    assert len(got) == len(rows) and got == brute_rows(rows, 20)
    assert S.remove_repeats(documents(spark, [])).count() == 0


def test_rows_that_share_an_id_or_have_none_stay_apart(spark):
    vocab = vocabulary(200)
    one, two = texts(2, 60, vocab, 3)
    one, two = one + " " + " ".join(vocab[:30]), two + " " + " ".join(vocab[:30])
    rows = [(1, one), (1, two), (None, two), (None, one), (2, "short"), (2, "short"), (None, None), (None, "short")]
    assert removed(spark, rows) == brute_rows(rows, 20)
    many = [(None, t) for t in texts(40, 80, vocab, 9)] + [(7, t) for t in texts(40, 80, vocab, 9)]  # an id on half of the rows
    many += [(None, " ".join(vocab[:30]))] * 20
    assert removed(spark, many) == brute_rows(many, 20)


def test_local_settlement_needs_document_order():
    """Equal segments in one task: all but the first are spans, unless documents come out of order."""
    found = [{"anchor": np.array([5, 5, 7]), "doc": np.array([1, 2, 2]), "start": np.zeros(3, np.int32), "n": np.ones(3, np.int32), "shard": np.zeros(3, np.int32)}]
    assert S._settled(found).column("times").to_pylist() == [2, 0, 1]


def test_passages_join_windows_that_always_follow():
    ids = np.array([1, 2, 3, 4, 5, 0, 9, 1, 2, 3, 4, 0, 1, 2, 3, 4, 5, 0])
    rank = np.array([0] * 6 + [1] * 6 + [2] * 6)
    at, count = S.passages(ids, rank, 3)
    assert sorted(zip(at.tolist(), count.tolist(), strict=True)) == [(0, 2), (2, 1)]
    late, n = S.repeated_passages(ids, rank, 9, 3)
    assert sorted(zip(late.tolist(), n.tolist(), strict=True)) == [(7, 2), (12, 2), (14, 1)]


def test_wide_alphabet(monkeypatch):
    monkeypatch.setattr(S, "ALPHABET", 4)
    ids = np.array([1, 2, 3, 0, 5, 1, 2, 3, 0, 4, 1, 1, 2, 0])
    rank = np.array([0] * 4 + [1] * 5 + [2] * 5)
    late, n = S.repeated_passages(ids, rank, 9, 3)
    assert late.tolist() == [5] and n.tolist() == [1]
