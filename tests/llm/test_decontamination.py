import random
import re

import pytest

from reqlens.llm import decontamination as D
from tests.llm.fixtures import awkward_rows, documents, texts, vocabulary

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().lower())


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = terms(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item) if item is not None else "")
    out = []
    for doc, text in docs:
        w, hit, found = terms(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' AS item", "'clash' AS words", "'x' AS id")


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items)) for r in df.collect()), key=str)


@pytest.mark.parametrize("most", [200_000, 40])
def test_matches_brute_force(spark, most):
    """Also with the test windows cut into slices."""
    rng = random.Random(4)
    vocab = vocabulary(120)
    items = [(i, t) for i, t in enumerate(texts(12, 25, vocab, 9))] + [(3, "Zwölf Boxkämpfer"), (None, "lone"), (70, None), (71, "!!"), (72, "")]
    docs = []
    for d, text in enumerate(texts(80, 60, vocab, 5)):
        part = rng.choice(items)[1] or ""
        docs.append((d, f"{text}, {part.upper() if rng.random() < 0.5 else part}; {text[:30]}" if rng.random() < 0.7 else text))
    docs += [(500 + k, docs[0][1]) for k in range(40)] + [(900, "a zwölf, boxkämpfer-b"), (901, "lone lone")]
    df = documents(spark, [(d, t, None, None, None) for d, t in docs], clashes=True)
    got = D.contamination(df, items_of(spark, items), window=6, most_windows=most)
    # A-Z alone are lower-cased, so Z and Ö in capitals differ in the second only
    assert result(got) == brute(docs, items, 6)


def test_awkward_rows(spark):
    rows = awkward_rows()
    df = documents(spark, rows, clashes=True)
    items = [(1, rows[0][1]), (2, "12345 67890"), (None, None)]
    assert result(D.contamination(df, items_of(spark, items))) == brute([r[:2] for r in rows], items, 10)
    assert D.contamination(documents(spark, []), items_of(spark, items)).count() == 0
    none = D.contamination(df, items_of(spark, []).limit(0)).collect()
    assert len(none) == len(rows) and all(r.n_hit == 0 and r["items"] == [] for r in none)


def test_near_matches(spark):
    """Rare words of a window close together, but not the phrase."""
    docs = [(1, "quick zebra then brown yak jumps"), (2, "quick brown zebra yak"), (3, "quick " + "filler " * 40 + "zebra brown yak")]
    df = documents(spark, [(d, t, None, None, None) for d, t in docs])
    got = {r.doc_id: r for r in D.contamination(df, items_of(spark, [(7, "quick brown zebra yak")])).collect()}
    assert [got[d].near_items for d in (1, 2, 3)] == [["7"], [], []]
    assert [got[d]["items"] for d in (1, 2, 3)] == [[], ["7"], []]
