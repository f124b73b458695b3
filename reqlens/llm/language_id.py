"""Language identification by nearest centroids.

A text is lower-cased, everything but letters becomes a single space, and its
byte n-grams of one to three bytes are hashed into ``bins``.  Damped counts
times inverse document frequencies, normalised, are its vector.  Each language
has up to ``centroids`` centroids (spherical k-means); a text gets the language
of the centroid with the highest cosine.

Rejection is by distance: similarity grows with a text's length, so each language
has its floors by length, at ``slack`` times a low quantile of the similarities that
its training texts of that length have.  Lengths with too few training texts get the
floor of the next shorter length that has enough, or, below all of those, the floor of
the shortest, falling with the square root of the length.

Learned from: document frequencies over all labelled training texts; centroids
and floors from at most about ``per_language`` training texts of each language,
fitted in one task per language.  Language values are classes of a model: over
1,000 of them are refused.

Defined cases: a text that is NULL or has no letter is `und`, score 0,
rejected; rows with a NULL or blank language teach nothing; without training rows
every text is `und`; each row is judged alone (repeated rows get equal results);
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import bounded_sample, chunks, documents, fold, lists, load, text_bytes

BINS = 4096
CENTROIDS = 4
PER_LANGUAGE = 500
SLACK = 0.3
#: Quantile of training similarities that floors are set by, and texts of a length that it takes.
LOW = 0.05
ENOUGH = 20
#: Texts whose vectors are held at once in a task.
ROWS = 64
UNKNOWN = "und"

_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x41:0x5B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 0x100)


class Model(NamedTuple):
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # of each centroid's language, by length class


def counts(texts: pa.Array, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (texts x bins) and n-grams per text."""
    data, at = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    clean = _KEEP[data]
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    if len(clean):
        keep = np.ones(len(clean), bool)
        keep[1:] = (clean[1:] != 0x20) | (clean[:-1] != 0x20) | (text[1:] != text[:-1])
        clean, text = clean[keep], text[keep]
    code = clean.astype(np.uint32)
    shift = np.uint32(32 - int(bins).bit_length() + 1)
    out = np.zeros(len(texts) * bins, np.int64)
    for n in (1, 2, 3):
        if len(clean) < n:
            break
        if n > 1:
            code = code[:-1] * np.uint32(256) + clean[n - 1 :]
        same = text[: len(code)] == text[n - 1 :]
        hashed = ((code + np.uint32(n << 24)) * np.uint32(2654435761)) >> shift
        out += np.bincount((text[: len(code)] * bins + hashed)[same], minlength=len(out))
    out = out.reshape(-1, bins)
    return out, out.sum(1)


def vectors(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(n.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def length_class(n_grams: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(n_grams, 1)).astype(int)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each n-gram bin in this task (and, as bin -1, all texts)."""
    df, n = np.zeros(BINS, np.int64), 0
    for b in _rows(batches):
        df += (counts(b.column("text"))[0] > 0).sum(0)
        n += b.num_rows
    yield pa.record_batch({"bin": pa.array(np.arange(-1, BINS)), "n": pa.array(np.append([n], df))})


def _vectors(idf: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches):
            n, grams = counts(b.column("text"))
            v = vectors(n, idf)
            yield pa.record_batch(
                {
                    "lang": b.column("lang"),
                    "grams": pa.array(grams),
                    "vector": lists(v.ravel(), np.full(len(v), BINS), pa.float32()),
                }
            )

    return run


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 20, seed: int = 42) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[[0]]
    while len(centres) < min(k, len(x)):  # far ones first, as in k-means++
        far = np.clip(1 - (x @ centres.T).max(1), 0, None)
        if far.sum() <= 1e-6:
            break
        centres = np.vstack([centres, x[rng.choice(len(x), p=far / far.sum())]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) for j in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1)
        centres = sums[norms > 0] / norms[norms > 0, None]
    return centres


def length_floors(near: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Low quantiles of one language's similarities by length class (of 64)."""
    known = {}
    for c in range(64):
        # a class with the next, so that the few texts of one don't decide alone
        if (size == c).any() and ((size == c) | (size == c + 1)).sum() >= ENOUGH:
            known[c] = np.quantile(near[(size == c) | (size == c + 1)], LOW)
    known = known or {int(size.max()): np.quantile(near, LOW)}
    shortest = min(known)
    return np.array([known[max(k for k in known if k <= c)] if c >= shortest else known[shortest] * 2 ** ((c - shortest) / 2) for c in range(64)])


def _fit(k: int):
    def run(table: pa.Table) -> pa.Table:
        x = table.column("vector").combine_chunks().values.to_numpy().reshape(-1, BINS)
        grams = table.column("grams").to_numpy()
        order = np.lexsort((*x[:, :8].T, grams))  # the same fit however rows arrive
        x, grams = x[order], grams[order]
        centres = spherical_kmeans(x, k).astype(np.float32)
        near, size = (x @ centres.T).max(1), length_class(grams)
        floor = length_floors(near, size).tolist()
        lang = table.column("lang")[0].as_py()
        return pa.table(
            {
                "lang": pa.array([lang] * len(centres)),
                "centre": lists(centres.ravel(), np.full(len(centres), BINS), pa.float32()),
                "floor": pa.array([floor] * len(centres), pa.list_(pa.float64())),
            }
        )

    return run


def train(docs: DataFrame, centroids: int = CENTROIDS, per_language: int = PER_LANGUAGE, slack: float = SLACK) -> Model:
    """A model from labelled texts (doc_id, text, lang)."""
    rows = documents(docs, "lang").where("text IS NOT NULL AND trim(lang) != ''")
    found = rows.select("text").mapInArrow(_frequencies, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    seen = {r.bin: r.n for r in found.collect()}  # a row per bin
    n = seen.get(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + seen.get(b, 0))) + 0.05 for b in range(BINS)], np.float32)
    sample = bounded_sample(rows, "lang", per_language)
    fitted = sample.mapInArrow(_vectors(idf), "lang string, grams long, vector array<float>").groupBy("lang").applyInArrow(
        _fit(centroids), "lang string, centre array<float>, floor array<double>"
    )
    rows = sorted(fitted.collect(), key=lambda r: (r.lang, r.centre))  # a few centroids per language
    floors = np.array([r.floor for r in rows]).reshape(-1, 64)
    centres = np.array([r.centre for r in rows], np.float32).reshape(-1, BINS)
    return Model([r.lang for r in rows], centres, idf, slack * floors)


def _predict(model: Model):
    langs = np.array(model.langs, object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches):
            texts = b.column("text").fill_null("")
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            pred = np.full(len(texts), UNKNOWN, object)
            score, reject = np.zeros(len(texts)), np.ones(len(texts), bool)
            if len(langs) and lettered.any():
                n, grams = counts(texts)
                near = np.clip(vectors(n, model.idf) @ model.centroids.T, 0, 1)
                best = near.argmax(1)
                top = near[np.arange(len(best)), best]
                pred[lettered], score[lettered] = langs[best][lettered], top[lettered]
                reject = ~lettered | (top < model.floors[best, length_class(grams)])
            rest = b.drop_columns(["text"])
            yield pa.record_batch(
                [*rest.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(reject)],
                names=[*rest.schema.names, "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (cosine to the nearest centroid), rejected of every row."""
    return documents(docs).mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language isn't rejected."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))
    kinds = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(_predict(model), kinds).where("NOT rejected").select("row.*")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = train(docs.where(fold(F.col("doc_id"), 4) != 2))
    done = identify(docs, model)
    return done.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
