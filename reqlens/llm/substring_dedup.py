"""Substring dedup by repeated-phrase automata.

A *window* is ``window`` consecutive words of one document.  A word is removed
if some window covering it has a word sequence that also starts earlier (in a
smaller doc_id, or earlier in the same document).  Windows are judged on the
input.

1. **Candidates.**  Each window's anchor is the least hash of its ``gram``-word
   sequences, so equal windows have equal anchors.  Neighbouring windows whose
   anchor stands at one place (the last, in ties) form a segment, about one per
   eight words; equal windows are in different segments.  Anchors are counted
   over the whole corpus with map-side sums; segments whose anchor comes up
   once cannot recur and end here.
2. **Confirmation and automata.**  The remaining segments go, with their words,
   to shards by anchor: all windows with one sequence meet in one shard.  A shard
   confirms the sequences found at least twice, joins those that always follow
   one another to passages, compiles these into an Aho-Corasick automaton and
   streams its segments through it in document order.  Each occurrence after a
   passage's first is a removed span.
3. **Removal.**  Spans return to their documents, which lose the covered words.

Skew: a task settles what it can alone.  An anchor that recurs within a task needs
no count from elsewhere (its segments join under keys of their own), and of
equal segments within a task only the first can be the first of all.  So a
passage that a third of all documents share reaches any one key, and its
shard, once per task.  Texts cross the network twice at most,
zstd-compressed, partitioned by row; all uses share one exchange.

Defined cases: each row is a document of its own and gives one row.  Rows that
share a doc_id, or have none (they sort last), stand in the order of the input, so
of repeated rows the later ones lose their words.  The input is a stored table, or
one that comes out in the same order each time it is read.  A NULL text has no words; a text of
fewer words than a window keeps them all.  Other columns are ignored.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import (
    NO_ID,
    documents,
    chunks,
    find_words,
    hash_words,
    load,
    mix,
    shuffle_partitions,
    text_bytes,
)

WINDOW = 20
GRAM = 6
#: Bytes of segment words that a task holds before it passes them on.
HELD_BYTES = 24 << 20
#: Segments whose anchors a task compares before it passes them on.
HELD_SEGMENTS = 1 << 20
#: Word numbers that one character of an automaton's alphabet can stand for (0 and 1 are kept free).
ALPHABET = 1_000_000


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        texts = [pack(t) for t in b.column("text").cast(pa.binary()).fill_null(b"").to_pylist()]
        yield pa.record_batch({"doc": b.column("doc"), "row": b.column("row"), "z": pa.array(texts, pa.binary())})


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for b in batches:
        at = b.schema.get_field_index("z")
        column = b.column(at).to_pylist()
        lo, held = 0, 0
        texts: list[bytes] = []
        for i, z in enumerate(column):
            texts.append(unpack(z))
            held += len(texts[-1])
            if held >= 4 << 20 or i + 1 == len(column):
                yield b.slice(lo, i + 1 - lo).set_column(at, "text", pa.array(texts, pa.large_binary()))
                lo, held, texts = i + 1, 0, []


def _least_in(a: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of each ``width`` neighbours, and the last place where it stands."""
    have, place = 1, np.arange(len(a))
    while have < width:
        step = min(have, width - have)
        right = a[step:] <= a[:-step]
        a, place = np.where(right, a[step:], a[:-step]), np.where(right, place[step:], place[:-step])
        have += step
    return a, place


def segments(word_hash: np.ndarray, text: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and anchor of each segment in a chunk's words."""
    n = len(word_hash) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(word_hash) - gram + 1, np.uint64)
    for j in range(gram):
        grams += word_hash[j : j + len(grams)] * np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64)
    anchor, place = _least_in(mix(grams), window - gram + 1)
    whole = text[:n] == text[window - 1 :]
    fresh = whole.copy()
    fresh[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    begin = np.flatnonzero(fresh)
    kept = np.flatnonzero(whole)
    count = np.diff(np.append(np.searchsorted(kept, begin), len(kept)))
    return begin, count, anchor[begin]


def _settled(found: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
    """Segments with ``times``, their anchor's count here: 1, or 2 (for more) on the first of them and 0 on the others."""
    columns = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
    _, first, which, many = np.unique(columns["anchor"], return_index=True, return_inverse=True, return_counts=True)
    times = np.where(many[which] > 1, 0, 1).astype(np.int32)
    times[first[many > 1]] = 2
    return pa.record_batch({**{k: pa.array(v) for k, v in columns.items()}, "times": pa.array(times)})


def _anchors(window: int, gram: int, n_shards: int):
    def run(batches):
        found: list[dict[str, np.ndarray]] = []
        held = 0
        for b in _unpacked(batches):
            w = find_words(*text_bytes(b.column("text")))
            begin, count, anchor = segments(hash_words(w), w.text, window, gram)
            of = w.text[begin]
            docs, rows = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "row"))
            found.append(
                {
                    "anchor": anchor.view(np.int64),
                    "doc": docs[of].astype(np.int64),
                    "row": rows[of].astype(np.int64),
                    "start": (begin - w.first[of]).astype(np.int32),
                    "n": count.astype(np.int32),
                    "shard": (anchor % np.uint64(n_shards)).astype(np.int32),
                }
            )
            held += len(begin)
            if held >= HELD_SEGMENTS:
                yield _settled(found)
                found, held = [], 0
        if found:
            yield _settled(found)

    return run


class _Outbox:
    """Segments by shard, and removed spans, held until there are ``HELD_BYTES`` of them."""

    def __init__(self, n_shards: int):
        self.n_shards, self.rows, self.spans, self.held, self.turn = n_shards, {}, [], 0, 0

    def add(self, shard: int, of: tuple[int, int], start: int, words: bytes) -> None:
        self.rows.setdefault(shard, []).append((*of, start, words))
        self.held += len(words) + 16

    def flush(self) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        out = {"shard": [], "ids": [], "starts": [], "words": []}
        for shard, rows in self.rows.items():
            docs, of, starts, words = zip(*rows, strict=True)
            out["shard"].append(shard)
            out["ids"].append(pack(np.array([docs, of], np.int64).tobytes()))
            out["starts"].append(pack(np.array(starts, np.int32).tobytes()))
            out["words"].append(pack(b"\n".join(words)))
        for lo in range(0, len(self.spans), 4096):  # settled here: they only pass through, dealt out evenly
            docs, of, starts, ends = zip(*self.spans[lo : lo + 4096], strict=True)
            self.turn += 1
            out["shard"].append((docs[0] + self.turn) % self.n_shards)
            out["ids"].append(pack(np.array([docs, of], np.int64).tobytes()))
            out["starts"].append(pack(np.array([starts, ends], np.int32).tobytes()))
            out["words"].append(None)
        self.rows, self.spans, self.held = {}, [], 0
        kinds = {"shard": pa.int32(), "ids": pa.binary(), "starts": pa.binary(), "words": pa.binary()}
        return pa.record_batch({k: pa.array(v, kinds[k]) for k, v in out.items()})


def _extract(window: int, n_shards: int):
    """Words of each document's candidate segments, packed by shard."""

    def run(batches):
        box, seen, last = _Outbox(n_shards), set(), None
        for b in _unpacked(batches):
            marks = b.column("marks")
            bounds = marks.offsets.to_pylist()
            begins, counts, shards = (marks.values.field(k).to_pylist() for k in ("start", "n", "shard"))
            for i, (*of, text) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc", "row", "text")), strict=True)):
                of = tuple(of)
                if last is not None and of < last:
                    seen = set()  # what was seen must come earlier in document order
                last = of
                words = text.split()
                joined = b" ".join(words)
                at = list(accumulate([len(x) + 1 for x in words], initial=0))
                lo = hi = -1
                for j in range(bounds[i], bounds[i + 1]):
                    start = begins[j]
                    to = start + counts[j] + window - 1
                    part = joined[at[start] : at[to] - 1]
                    key = xxhash.xxh3_128_digest(part)
                    if key not in seen:
                        seen.add(key)
                        box.add(shards[j], of, start, part)
                    elif start <= hi:
                        hi = to
                    else:
                        if hi > lo:
                            box.spans.append((*of, lo, hi))
                        lo, hi = start, to
                if hi > lo:
                    box.spans.append((*of, lo, hi))
            if box.held + 40 * len(box.spans) >= HELD_BYTES:
                yield box.flush()
        yield box.flush()

    return run


def _alphabet(ids: np.ndarray, n_words: int) -> tuple[str, int]:
    """Word numbers (0: a break) as text, and how many characters each takes."""
    width = 1 if n_words < ALPHABET else 2
    digits = ids[:, None] if width == 1 else np.stack([ids // ALPHABET, ids % ALPHABET], 1)
    codes = digits.ravel().astype(np.uint32) + np.uint32(1)
    codes += np.uint32(0x800) * (codes >= 0xD800)  # surrogates aren't characters
    return codes.tobytes().decode("utf-32-le"), width


def passages(ids: np.ndarray, rank: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of windows of each recurring passage in ``ids`` (word numbers, 0 between rows).

    A passage is a run of windows found twice or more that always follow one
    another: wherever its first window stands, the whole passage stands.
    """
    n = len(ids) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none
    scrambled, sums = mix(ids.astype(np.uint64) + np.uint64(7)), np.zeros(n, np.uint64)
    for j in range(window):
        sums += scrambled[j : j + n] * np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64)
    at = np.flatnonzero((rank[:n] == rank[window - 1 :]) & (ids[:n] > 0) & (ids[window - 1 :] > 0))
    _, which, times = np.unique(sums[at], return_inverse=True, return_counts=True)
    again = times[which] > 1
    at, which = at[again], which[again]
    if not len(at):
        return none, none
    follows = np.flatnonzero(at[1:] == at[:-1] + 1)
    one, two = which[follows], which[follows + 1]
    first_next, last_next = np.full(len(times), len(times)), np.full(len(times), -1)
    np.minimum.at(first_next, one, two)
    np.maximum.at(last_next, one, two)
    # every place of a window is followed by the same next one, which stands nowhere else
    bound = (first_next == last_next) & (np.bincount(one, minlength=len(times)) == times)
    bound &= times[np.minimum(first_next, len(times) - 1)] == times
    bound &= first_next != np.arange(len(times))
    inner = np.zeros(len(times), bool)
    inner[first_next[bound]] = True
    # each passage once: from its first place, on to the first window not bound to its next
    _, begin = np.unique(which, return_index=True)
    begin = begin[~inner[which[begin]]]
    stop = np.flatnonzero(~bound[which])
    return at[begin], stop[np.searchsorted(stop, begin)] - begin + 1


def repeated_passages(ids: np.ndarray, rank: np.ndarray, n_words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of windows of all occurrences of recurring passages but each one's first, by automaton."""
    begin, count = passages(ids, rank, window)
    if not len(begin):
        return begin, count
    text, width = _alphabet(ids, n_words)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (lo, hi) in enumerate(zip((begin * width).tolist(), ((begin + count + window - 1) * width).tolist(), strict=True)):
        automaton.add_word(text[lo:hi], k)
    automaton.make_automaton()
    hits = np.array(list(automaton.iter(text)), np.int64).reshape(-1, 2)
    which = hits[:, 1]
    end, aligned = (hits[:, 0] + 1) // width, (hits[:, 0] + 1) % width == 0
    which, at = which[aligned], end[aligned] - count[which[aligned]] - window + 1
    later = np.ones(len(at), bool)
    later[np.unique(which, return_index=True)[1]] = False
    return at[later], count[which[later]]


def _locate(window: int):
    def spans(ids, starts, ends):
        own = {"doc": pa.array(ids[0], pa.int64()), "row": pa.array(ids[1], pa.int64())}
        return pa.table({**own, "start": pa.array(starts, pa.int32()), "end": pa.array(ends, pa.int32())})

    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        out, docs, starts, texts = [], [], [], []
        for ids, at, words in zip(*(table.column(c).to_pylist() for c in ("ids", "starts", "words")), strict=True):
            ids, at = np.frombuffer(unpack(ids), np.int64).reshape(2, -1), np.frombuffer(unpack(at), np.int32)
            if words is None:
                out.append(spans(ids, *at.reshape(2, -1)))
            else:
                docs.append(ids)
                starts.append(at)
                texts += unpack(words).split(b"\n")
        if texts:
            docs, starts = np.concatenate(docs, axis=1), np.concatenate(starts)
            number: dict[bytes, int] = {}
            ids, counts = [], []
            order = np.lexsort((starts, docs[1], docs[0]))
            for r in order.tolist():
                words = texts[r].split(b" ")
                ids += [number.setdefault(x, len(number) + 1) for x in words]
                ids.append(0)
                counts.append(len(words) + 1)
            rank = np.repeat(np.arange(len(order)), counts)
            begin = np.cumsum(counts) - counts
            late, count = repeated_passages(np.array(ids, np.int64), rank, len(number), window)
            r = order[rank[late]]
            at = starts[r] + (late - begin[rank[late]])
            out.append(spans(docs[:, r], at, at + count + window - 1))
        return pa.concat_tables(out) if out else spans(([], []), [], [])

    return run


def _remove(batches):
    for b in _unpacked(batches):
        out = {"n_words": [], "n_removed": [], "removed": [], "kept_text": []}
        for text, marks in zip(b.column("text").to_pylist(), b.column("removed").to_pylist(), strict=True):
            words = text.split()
            spans: list[list[int]] = []
            for m in sorted(marks or (), key=lambda m: m["start"]):
                if spans and m["start"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], m["end"])
                else:
                    spans.append([m["start"], m["end"]])
            kept, at = [], 0
            for lo, hi in spans:
                kept += words[at:lo]
                at = hi
            kept += words[at:]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["removed"].append([{"start": lo, "end": hi} for lo, hi in spans])
            out["kept_text"].append(b" ".join(kept))
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.record_batch(
            {
                "doc": b.column("doc"),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "removed": pa.array(out["removed"], spans_type),
                "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string()),
            }
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, n_shards: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, removed (word spans ``[start, end)``), kept_text of every document.

    ``n_shards`` (four per shuffle partition unless given) sets how many
    automata the recurring passages are dealt to.
    """
    shards = n_shards or 4 * shuffle_partitions(docs.sparkSession)
    # a row's key is its doc_id and its place in the input: rows that share an id, or have none, stay apart
    keyed = documents(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.monotonically_increasing_id().alias("row"), "text")
    texts = keyed.mapInArrow(_packed, "doc long, row long, z binary").repartition("doc", "row")
    found = texts.mapInArrow(_anchors(window, gram, shards), "anchor long, doc long, row long, start int, n int, shard int, times int")
    recurring = found.where("times > 0").groupBy("anchor").agg(F.sum("times").alias("total")).where("total > 1")
    # segments whose anchor recurs within their task are settled; the join decides on the others
    settled = F.col("times") != 1
    spread = F.xxhash64("doc", "row", "start")
    asked = found.withColumn("key", F.when(settled, spread).otherwise(F.col("anchor"))).withColumn("settled", settled)
    marks = (
        asked.select("key", "doc", "row", "start", "n", "shard", "settled")
        .join(recurring.select(F.col("anchor").alias("key"), F.lit(True).alias("again")), "key", "left")
        .where("settled OR again")
        .groupBy("doc", "row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "n", "shard"))).alias("marks"))
    )
    routed = texts.join(marks, ["doc", "row"]).mapInArrow(_extract(window, shards), "shard int, ids binary, starts binary, words binary")
    spans = routed.groupBy("shard").applyInArrow(_locate(window), "doc long, row long, start int, end int")
    removed = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("removed"))
    kept = texts.join(removed, ["doc", "row"], "left").mapInArrow(
        _remove, "doc long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string"
    )
    return kept.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "removed", "kept_text"
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(load(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
