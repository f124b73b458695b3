"""Shared pieces of the corpus operators.

Python work runs in ``mapInArrow`` / ``applyInArrow`` tasks over Arrow batches.
A batch's texts are handled as one byte buffer, so tokenising and hashing are a
few numpy passes instead of a Python loop per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqlens.session import shared_folder

#: Bytes of text handled at once in a task (a longer document is handled alone).
CHUNK_BYTES = 4 << 20
#: Bytes of words hashed at once (a longer word is hashed alone): a pass holds some fifty bytes for each.
HASH_BYTES = 1 << 18

#: Stands for a NULL doc_id inside shuffles: such rows sort last.
NO_ID = 2**63 - 1

_WHITESPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: Words `[^\x20\x09-\x0D]+`: every byte but ASCII white space.
PLAIN_WORD = np.ones(256, bool)
PLAIN_WORD[list(_WHITESPACE)] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: digits, letters and all beyond ASCII.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x80:] = True
#: Byte values as they are, and with A-Z lower-cased.
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 0x20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values so that order and low bits look random."""
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 1024), _MULT, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


class Words(NamedTuple):
    """Words of a chunk of texts: byte spans, the text each is in, and where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its texts (a null is empty)."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def find_words(data: np.ndarray, at: np.ndarray, word_bytes: np.ndarray = PLAIN_WORD) -> Words:
    inside = word_bytes[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[at] = True  # a text begins, the last one ends
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | fresh[1:-1]
        ends[:-1] &= ~inside[1:] | fresh[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, start, end, text, first)


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    n = end - start
    to = np.cumsum(n)
    inside = np.arange(to[-1]) - np.repeat(to - n, n)
    at = inside + np.repeat(start, n)
    parts = (value[data[at]].astype(np.uint64) + np.uint64(1)) * powers(int(n.max()))[inside]
    return mix(np.add.reduceat(parts, to - n) + n.astype(np.uint64))


def hash_words(w: Words, value: np.ndarray = AS_IS, most: int = HASH_BYTES) -> np.ndarray:
    """A 64-bit hash of each word's bytes (after the byte mapping ``value``)."""
    out = np.zeros(len(w.start), np.uint64)
    to = np.cumsum(w.end - w.start)
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(to, (to[lo - 1] if lo else 0) + most, "right")))
        out[lo:hi] = _hash(w.data, w.start[lo:hi], w.end[lo:hi], value)
        lo = hi
    return out


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from its flat values and the length of each list."""
    to = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(to), pa.array(values, kind))


# --- Spark helpers ---------------------------------------------------------------


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and ``more`` of a table, whatever other columns it has."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), *[docs[c] for c in more])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``: the folds of the labelled tables (no id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def word_array(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, JVM-side (NULL has none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), "")


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the lineage, outlives any executor."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def _first(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The ``most`` rows of each value of ``by`` with the least ``_h``, a hash.

    Spark trims a window to its first rows in each task where it asks for 1,000 of them at most, so values are ranked in slices of
    the hash first, of 500 expected rows each; then a value is left with a bounded number of rows.
    """
    slices = -(-most // 500)
    inner = Window.partitionBy(by, "_slice").orderBy("_h")
    few = rows.withColumn("_slice", F.pmod(F.shiftright("_h", 20), F.lit(slices))).withColumn("_at", F.row_number().over(inner)).where(F.col("_at") <= 1000)
    return few.withColumn("_at", F.row_number().over(Window.partitionBy(by).orderBy("_h"))).where(F.col("_at") <= most).drop("_slice", "_at")


def bounded_sample(rows: DataFrame, by: str, most: int, seed: int = 42) -> DataFrame:
    """``most`` distinct rows of each value of ``by``, or all it has, the same on each run.

    ``rows`` (doc_id, text, ``by`` and others) are drawn by a hash of doc_id and text, so ids may repeat or be NULL;
    a row that repeats counts once.  One slim pass finds each value's highest hash that still belongs, and the few rows
    below are read with their texts.
    """
    keyed = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))))
    drawn = _first(keyed.select(by, "_h").distinct(), by, most)
    # staged, so that Spark knows its size: a row per value, joined as that allows
    cuts = staged(drawn.groupBy(by).agg(F.max("_h").alias("_cut")))
    return keyed.join(cuts, by).where("_h <= _cut").dropDuplicates([by, "_h"]).drop("_h", "_cut")


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """doc_id, text, label of ``most`` distinct documents of each label (0 and 1), or all there are.

    Of several labels of one id the larger holds; an id that documents share labels each of their texts; NULL ids have none.
    """
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    keyed = documents(docs).withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))))
    drawn = _first(keyed.select("doc_id", "_h").distinct().join(known, "doc_id"), "label", most)
    chosen = staged(drawn.select("doc_id", "_h", "label"))
    # bounded: 2 x most rows
    return keyed.join(F.broadcast(chosen), ["doc_id", "_h"]).dropDuplicates(["doc_id", "_h"]).select("doc_id", "text", "label")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
