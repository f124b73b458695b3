"""Benchmark decontamination with a positional inverted index.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased.
A test item's windows are its runs of ``window`` words; an item of fewer words,
but not none, is one window.

1. **Index.**  Training documents are cut into blocks of a few MB of whole texts.
   For each block and each term that a test window can ask for, the term's
   positions are stored as one posting list of gaps, a table in the shared
   folder.  Documents of a block are numbered apart by more than any window, so
   no match runs across two of them.
2. **Search.**  The stored lists give each term's frequency.  In each block every
   window starts from its rarest term's list, shifted by the term's offset, and
   intersects it with the next rarest until no start is left or all terms agree
   (equally rare terms go by code point).
   What stays is an exact phrase match.  A *near* match needs the window's
   ``near_terms`` rarest terms within ``near_span`` words of the rarest, in any order.
3. **Result.**  Matches are joined back to documents and test items.

Lists are keyed by block and term, so a frequent term is spread over all
blocks, and a block has a bounded size.  Test windows go to every task, at most
about ``most_windows`` at a time: a larger test set is searched in slices of
that size, each over all documents.

Defined cases: a NULL or wordless text has no matches (n_words 0), a NULL or
wordless item has no windows; items that share an item_id are one item, a NULL
item_id counts as empty text; each input row is a document, also with a repeated
or NULL doc_id; other columns are ignored; empty tables give no matches or no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import (
    ALNUM_WORD,
    LOWER,
    chunks,
    documents,
    find_words,
    hash_words,
    lists,
    load,
    staged,
    text_bytes,
)

WINDOW = 10
NEAR_TERMS = 4
NEAR_SPAN = 30
MOST_WINDOWS = 200_000
#: The term number of a block's list of document starts.
STARTS = -1

_ROWS = "is_doc boolean, block long, term int, gaps array<int>, doc_no int, doc_id long, n_words long"


def _test_windows(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = text_bytes(b.column("text"))
            w = find_words(data, at, ALNUM_WORD)
            low = LOWER[data].tobytes()
            items, windows = [], []
            for i, item in enumerate(b.column("item").to_pylist()):
                words = [low[s:e].decode() for s, e in zip(w.start[w.of(i)].tolist(), w.end[w.of(i)].tolist(), strict=True)]
                for k in range(max(1, len(words) - size + 1) if words else 0):
                    items.append(item)
                    windows.append(words[k : k + size])
            yield pa.record_batch({"item": pa.array(items, pa.string()), "words": pa.array(windows, pa.list_(pa.string()))})

    return run


def test_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """id, words, items (sorted ids as text) of each distinct window of the test items (item_id, text)."""
    source = items.select(
        F.coalesce(items["item_id"].cast("string"), F.lit("")).alias("item"), items["text"].cast("string").alias("text")
    )
    found = source.mapInArrow(_test_windows(window), "item string, words array<string>")
    return found.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.xxhash64("words").alias("id"), "words", "items"
    )


def _term_hashes(terms: list[str]) -> np.ndarray:
    data, at = text_bytes(pa.array(terms, pa.string()))
    return hash_words(find_words(data, at, ALNUM_WORD), LOWER)


def _index(terms: list[str], apart: int):
    """Posting lists of the terms (numbered in hash order) and one row per document, for blocks of documents."""
    known = np.sort(_term_hashes(terms))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(chunks(batches)):
            block = (part << 32) + n
            data, at = text_bytes(b.column("text"))
            w = find_words(data, at, ALNUM_WORD)
            hashes = hash_words(w, LOWER)
            place = np.arange(len(hashes)) + w.text * apart
            term = np.searchsorted(known, hashes)
            hit = np.flatnonzero(known[np.minimum(term, len(known) - 1)] == hashes) if len(known) else term[:0]
            hit = hit[np.argsort(term[hit], kind="stable")]
            term, place = term[hit], place[hit]
            cut = np.flatnonzero(np.diff(term, prepend=-1))
            starts = w.first[:-1] + np.arange(b.num_rows) * apart
            # the block's lists: of document starts, then of each term; as gaps from 0
            firsts = np.concatenate([[0], len(starts) + cut]).astype(np.int64)
            gaps = np.diff(np.concatenate([starts, place]), prepend=0)
            gaps[firsts] = np.concatenate([starts[:1], place[cut]])
            sizes = np.diff(np.append(firsts, len(gaps)))
            numbers = np.concatenate([[STARTS], term[cut]]).astype(np.int32)
            m, d = len(numbers), b.num_rows
            none = lambda k, kind: pa.nulls(k, kind)
            yield pa.record_batch(
                {
                    "is_doc": pa.array(np.repeat([False, True], [m, d])),
                    "block": pa.array(np.full(m + d, block, np.int64)),
                    "term": pa.concat_arrays([pa.array(numbers), none(d, pa.int32())]),
                    "gaps": pa.concat_arrays([lists(gaps.astype(np.int32), sizes, pa.int32()), none(d, pa.list_(pa.int32()))]),
                    "doc_no": pa.concat_arrays([none(m, pa.int32()), pa.array(np.arange(d, dtype=np.int32))]),
                    "doc_id": pa.concat_arrays([none(m, pa.int64()), b.column("doc_id").cast(pa.int64())]),
                    "n_words": pa.concat_arrays([none(m, pa.int64()), pa.array(np.diff(w.first))]),
                }
            )

    return run


def build_index(docs: DataFrame, terms: list[str], apart: int) -> DataFrame:
    """The stored index of ``terms`` (see the module) over all documents."""
    return staged(documents(docs).mapInArrow(_index(terms, apart), _ROWS), "is_doc")


def _within(lead: np.ndarray, other: np.ndarray, span: int) -> np.ndarray:
    """Whether ``other`` has a position within ``span`` of each of ``lead``."""
    at = np.searchsorted(other, lead - span)
    return (at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= lead + span)


def match(postings: dict[int, np.ndarray], terms: list[tuple[int, int]]) -> np.ndarray:
    """Starts of a phrase, given its (term, offset) pairs from the rarest on: offset-adjusted lists, intersected."""
    none = np.zeros(0, np.int64)
    if any(t not in postings for t, _ in terms[:2]):
        return none
    at = postings[terms[0][0]] - terms[0][1]
    for t, offset in terms[1:]:
        other = postings.get(t, none)
        if not len(at) or not len(other):
            return none
        i = np.minimum(np.searchsorted(other, at + offset), len(other) - 1)
        at = at[other[i] == at + offset]
    return at


def _search(plans: list[tuple[int, list[tuple[int, int]]]], near_terms: int, near_span: int):
    """For each document of a block with matches: matched spans, ids of exact and of near windows."""

    def run(table: pa.Table) -> pa.Table:
        postings = {
            t: np.cumsum(g.values.to_numpy(zero_copy_only=False), dtype=np.int64)
            for t, g in zip(table.column("term").to_pylist(), table.column("gaps").combine_chunks(), strict=True)
        }
        starts = postings.pop(STARTS)
        found: dict[int, tuple[list, set, set]] = {}
        for key, terms in plans:
            if terms[0][0] not in postings:
                continue
            for at in (hits := match(postings, terms)).tolist():
                d = int(np.searchsorted(starts, at, "right")) - 1
                spans, exact, _ = found.setdefault(d, ([], set(), set()))
                spans.append((at - int(starts[d]), at - int(starts[d]) + len(terms)))
                exact.add(key)
            rare = list(dict.fromkeys(t for t, _ in terms))[:near_terms]
            if len(hits) < len(lead := postings[rare[0]]) and all(t in postings for t in rare):
                for t in rare[1:]:
                    lead = lead[_within(lead, postings[t], near_span)]
                for d in np.unique(np.searchsorted(starts, lead, "right") - 1).tolist():
                    found.setdefault(d, ([], set(), set()))[2].add(key)
        rows = []
        for d, (spans, exact, close) in sorted(found.items()):
            joined: list[list[int]] = []
            for lo, hi in sorted(spans):
                if joined and lo <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], hi)
                else:
                    joined.append([lo, hi])
            rows.append((d, [{"start": lo, "end": hi} for lo, hi in joined], sorted(exact), sorted(close - exact)))
        block = table.column("block")[0].as_py()
        kinds = [pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = zip(("doc_no", "spans", "exact", "near"), kinds, zip(*rows, strict=True) if rows else [()] * 4, strict=True)
        return pa.table({"block": pa.array([block] * len(rows), pa.int64()), **{k: pa.array(v, kind) for k, kind, v in columns}})

    return run


def _slice_hits(docs: DataFrame, windows: DataFrame, near_terms: int, near_span: int, window: int) -> tuple[DataFrame, DataFrame]:
    """Rows of all documents, and of those with matches, for one slice of windows."""
    asked = [(r.id, list(r.words)) for r in windows.collect()]
    names = sorted({t for _, words in asked for t in words})
    hashes = _term_hashes(names)
    names = [names[i] for i in np.argsort(hashes)]
    number = {t: i for i, t in enumerate(names)}
    index = build_index(docs, names, max(window, near_span) + 1)
    lists_ = index.where("NOT is_doc")
    # one row per term of the slice
    often = {r.term: r.n for r in lists_.groupBy("term").agg(F.sum(F.size("gaps")).alias("n")).collect()}
    plans = []
    for key, words in asked:
        terms = sorted(((number[t], k) for k, t in enumerate(words)), key=lambda x: (often.get(x[0], 0), words[x[1]], x[1]))
        if often.get(terms[0][0]):
            plans.append((key, terms))
    rows = lists_.select("block", "term", "gaps").groupBy("block").applyInArrow(
        _search(plans, near_terms, near_span),
        "block long, doc_no int, spans array<struct<start:int,end:int>>, exact array<long>, near array<long>",
    )
    return index.where("is_doc").select("block", "doc_no", "doc_id", "n_words"), rows


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    near_terms: int = NEAR_TERMS,
    near_span: int = NEAR_SPAN,
    most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, spans (matched words, joined), items (with exact matches), near_items of every document."""
    windows = staged(test_windows(items, window))
    slices = max(1, math.ceil(windows.count() / most_windows))
    parts = [
        _slice_hits(docs, windows.where(F.pmod(F.col("id"), F.lit(slices)) == k).select("id", "words"), near_terms, near_span, window)
        for k in range(slices)
    ]
    hits = staged(reduce(DataFrame.unionByName, (rows for _, rows in parts)))  # read for spans, items and near items
    key = ["block", "doc_no"]
    names = windows.select("id", "items")

    def item_ids(kind: str) -> DataFrame:
        of = hits.select(*key, F.explode(kind).alias("id")).join(names, "id")
        return of.groupBy(*key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias(f"{kind}_items"))

    spans = hits.groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.withColumn(
        "n_hit", F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1)))))
    )
    none = F.array().cast("array<string>")
    return (
        parts[0][0]
        .join(spans, key, "left")
        .join(item_ids("exact"), key, "left")
        .join(item_ids("near"), key, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            F.coalesce("exact_items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
    )


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )
