"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

*Word vectors.*  A word is seen twice: as one of ``WORDS`` hashed words, and as
a shape (case, punctuation, digits, length, equal to the word before).  Each
has a sparse random index vector; its context vector is the sum of the index
vectors of the words and shapes up to ``SPAN`` places away, over *all* documents
(map-side sums, then one row per vector).  A word vector is the index vector
plus the normalised context vector.

*Document vector.*  The mean vector of the words and the mean vector of the shapes.

*Network.*  Two layers in numpy, trained on at most about ``per_label`` labelled
documents of either label; a temperature fitted on a fifth of them, which the
weights never saw, calibrates the probabilities.

Defined cases: an empty or NULL text has a zero vector and is scored like any
other; NULL labels teach nothing; rows of a document with several labels all
count; without both labels every score is 0.5; each row is judged alone; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import Words, chunks, documents, find_words, fold, hash_words, labelled_sample, lists, load, mix, text_bytes

WORDS = 8192
SHAPES = 3 * 4 * 2 * 2 * 4
TOKENS = WORDS + SHAPES
DIMS = 64
SPARSE = 2
SPAN = 2
PER_LABEL = 4000
HIDDEN = 32

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK &= ~(_LETTER | _DIGIT)


def index_vectors(seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each token's few non-zero entries."""
    x = mix((np.arange(TOKENS * SPARSE, dtype=np.uint64) + np.uint64(seed << 32)).reshape(TOKENS, SPARSE) * np.uint64(0x9E3779B97F4A7C15))
    return (x % np.uint64(DIMS)).astype(np.int64), np.where((x >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word and shape (numbered after the words) of each word."""
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = hash_words(w)
    of = lambda kind: np.add.reduceat(kind[w.data].astype(np.int32), w.start)
    upper, letters, marks, digits = of(_UPPER), of(_LETTER), np.minimum(of(_MARK), 3), of(_DIGIT) > 0
    case = np.where(upper == 0, 0, np.where((upper > 1) & (2 * upper > letters), 2, 1))
    again = np.zeros(len(hashes), np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (w.text[1:] == w.text[:-1])
    size = np.searchsorted([3, 6, 10], w.end - w.start, "right")
    shape = (((case * 4 + marks) * 2 + digits) * 2 + again) * 4 + size
    return (hashes % np.uint64(WORDS)).astype(np.int64), WORDS + shape


def context_sums(word: np.ndarray, shape: np.ndarray, text: np.ndarray, place: np.ndarray, sign: np.ndarray, out: np.ndarray) -> None:
    """Adds the index vectors of each token's neighbours to its row of ``out`` (flat: tokens x dims)."""
    for apart in range(1, SPAN + 1):
        same = np.flatnonzero(text[apart:] == text[:-apart])
        for left in (word, shape):
            for right in (word, shape):
                a, b = left[same], right[same + apart]
                for k in range(SPARSE):
                    out += np.bincount(a * DIMS + place[b, k], sign[b, k], minlength=len(out))
                    out += np.bincount(b * DIMS + place[a, k], sign[a, k], minlength=len(out))


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    sums = np.zeros(TOKENS * DIMS)
    for b in chunks(batches):
        w = find_words(*text_bytes(b.column("text")))
        context_sums(*tokens(w), w.text, place, sign, sums)
    sums = sums.reshape(TOKENS, DIMS)
    used = np.flatnonzero(sums.any(1))
    yield pa.record_batch(
        {"token": pa.array(used), "v": lists(sums[used].ravel(), np.full(len(used), DIMS), pa.float64())}
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Token vectors learned from all texts: a fixed TOKENS x DIMS matrix."""
    sums = docs.select("text").mapInArrow(_contexts, "token long, v array<double>")
    rows = sums.groupBy("token").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMS)]).collect()
    context = np.zeros((TOKENS, DIMS))
    for r in rows:
        context[r[0]] = r[1:]
    place, sign = index_vectors()
    own = np.zeros((TOKENS, DIMS))
    for k in range(SPARSE):
        np.add.at(own, (np.arange(TOKENS), place[:, k]), sign[:, k])
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    return (unit(own) + unit(context)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector and mean shape vector of each text."""
    w = find_words(*text_bytes(texts))
    out = np.zeros((len(texts), 2 * DIMS), np.float32)
    filled = np.flatnonzero(np.diff(w.first))
    if len(filled):
        size = np.diff(w.first)[filled, None]
        for k, t in enumerate(tokens(w)):
            out[filled, k * DIMS : (k + 1) * DIMS] = np.add.reduceat(vectors[t], w.first[filled], axis=0) / size
    return out


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = 400, decay: float = 1e-3, seed: int = 42) -> Network | None:
    """Adam on the cross-entropy of four fifths of the rows; the temperature minimises that of the rest."""
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    held = rng.permutation(len(y)) % 5 == 0
    if held.all() or y[~held].min() == y[~held].max():
        held[:] = False
    fit, target = x[~held].astype(np.float64), y[~held].astype(np.float64)
    mean, scale = fit.mean(0), fit.std(0) + 1e-3
    z = (fit - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        h = np.tanh(z @ p[0] + p[1])
        error = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - target) / len(target)
        back = error[:, None] * p[2] * (1 - h * h)
        grads = [z.T @ back + decay * p[0] / hidden, back.sum(0), h.T @ error + decay * p[2], error.sum(keepdims=True)]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if held.any():
        logit, truth = net.logits(x[held]), y[held].astype(float)
        loss = lambda t: np.logaddexp(0, -np.where(truth == 1, logit, -logit) / t).mean()
        net = net._replace(temperature=float(min(np.geomspace(0.25, 8, 61), key=loss)))
    return net


def _pool(vectors: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x = pooled(b.column("text"), vectors)
            yield pa.record_batch(
                {"doc_id": b.column("doc_id"), "label": b.column("label"), "x": lists(x.ravel(), np.full(len(x), 2 * DIMS), pa.float32())}
            )

    return run


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, per_label: int = PER_LABEL) -> Network | None:
    """A network from labelled documents: labels (doc_id, label of 0 or 1), at most ``per_label`` of each."""
    rows = labelled_sample(docs, labels, per_label).mapInArrow(_pool(vectors), "doc_id long, label int, x array<float>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.x))
    return train_network(np.array([r.x for r in rows]).reshape(-1, 2 * DIMS), np.array([r.label for r in rows]))


def _score(net: Network | None, vectors: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            p = net.probability(pooled(b.column("text"), vectors)) if net else np.full(b.num_rows, 0.5)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(p, pa.float64())})

    return run


def score(docs: DataFrame, net: Network | None, vectors: np.ndarray) -> DataFrame:
    """doc_id, score (probability of label 1) of every row."""
    return documents(docs).mapInArrow(_score(net, vectors), "doc_id long, score double")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    vectors = word_vectors(docs)
    taught = labels.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label"))
    done = score(docs, train(docs, taught, vectors), vectors)
    return done.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
