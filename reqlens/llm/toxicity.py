"""Toxicity: a subsequence string kernel, Nyström features and a support vector machine.

*Kernel.*  A word is its letters (case ignored, accents dropped; letters of other scripts
stand for themselves); a run of three or more single letters also counts as the word it
spells.  Two words are compared by the subsequences of three letters that they
share, letters up to ``SPAN`` places apart, each weighted ``DECAY`` to the power
of its span, and the product is normalised.  A word with inserted letters keeps
most of its subsequences and so stays near the word that it hides.

*Landmarks.*  Words of labelled documents: those typical of toxic ones, and the most frequent
ones of the others.  A word is typical if it comes up in toxic documents more often than
chance allows, among all words tested (false discovery rate ``FALSE_DISCOVERY``): a few
accidental words of a few documents teach nothing.  A sentence is, for each landmark, the
kernel value of its closest word; the inverse root of the landmarks' own kernel
matrix turns that into Nyström features.

*Training* on sentences: of a document that isn't toxic the ``SENTENCES`` nearest to a typical
landmark are negative (the others lie further from the plane); of a toxic document the sentence
that scores highest is positive, and chosen again after each fit.  Positive sentences are added
with their landmark spelled with inserted letters.  A document scores as its worst sentence, through
a logistic curve whose slope and offset are fitted on documents that the machine did not see (each half
by a machine trained on the other), weighing labels as often as they come up among all that are labelled, and
toxic ones ``MISS_COST`` times.

At most ``per_label`` documents of each label are fitted on; all texts are scored whole.

Defined cases: an empty or NULL text has no sentence and scores as one without
any landmark; NULL labels teach nothing; without both labels, or without any typical word, every score is 0.5;
each row is judged alone; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import chunks, documents, find_words, fold, labelled_sample, lists, load, mix, powers, staged, text_bytes

SPAN = 5
DECAY = 0.7
#: The normalised kernel is raised to this power (again a kernel): many faint likenesses don't add up to one.
POWER = 3
TYPICAL = 80
FREQUENT = 24
#: Of the words taken for typical, the share that may be so by accident.
FALSE_DISCOVERY = 0.01
PER_LABEL = 2000
#: A toxic document missed costs as much as so many others taken for toxic: what a score of one half means.
MISS_COST = 4
#: Sentences that a training document gives at most: those nearest to a typical landmark.
SENTENCES = 8
#: Texts' bytes handled at once, and words whose kernel values a task remembers.
BYTES = 2 << 20
REMEMBERED = 1 << 17
#: Words of a sentence that are compared in one piece.
PIECE = 32

#: Letters a-z are 1 to 26, digits 27, other letters ``OTHER`` and their code point; marks (after decomposition) are dropped.
#: The kernel also sees where a word begins (29) and ends (30).
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[0x61:0x7B] = _SYMBOL[0x41:0x5B] = np.arange(1, 27)
_SYMBOL[0x30:0x3A] = 27
BEGIN, END, OTHER = 29, 30, 32
MARKS = (0x300, 0x370)
#: Codes of three letters: exact ones of the first 32 symbols, hashes of the others.
CODES = 1 << 18
_CLOSING = np.zeros(256, bool)
_CLOSING[[ord(c) for c in ".!?"]] = True


class Units(NamedTuple):
    """Words of a chunk as symbols: distinct ones (flat symbols, sizes, hashes), each word's number, sentences and texts."""

    symbols: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray  # ascending
    number: np.ndarray
    sentence: np.ndarray  # first word of each sentence
    text: np.ndarray  # of each sentence
    word_text: np.ndarray
    spelled: list[tuple[int, np.ndarray]]  # first word and symbols of each spelled-out run


def _take(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    to = np.cumsum(sizes)
    return values[np.arange(to[-1] if len(to) else 0) + np.repeat(first - (to - sizes), sizes)]


def _symbols(raw: np.ndarray) -> np.ndarray:
    """A symbol for each byte of UTF-8 text: a letter's at its first byte, 0 for bytes that are none."""
    out = _SYMBOL[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        byte = lambda k: raw[np.minimum(lead + k, len(raw) - 1)].astype(np.int64) & 0x3F
        first = raw[lead].astype(np.int64)
        two = ((first & 0x1F) << 6) | byte(1)
        three = ((first & 0x0F) << 12) | (byte(1) << 6) | byte(2)
        four = ((first & 0x07) << 18) | (byte(1) << 12) | (byte(2) << 6) | byte(3)
        point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
        out[lead] = np.where((point >= MARKS[0]) & (point < MARKS[1]), 0, OTHER + point)
    return out


def units(texts: pa.Array) -> Units:
    data, at = text_bytes(pc.utf8_normalize(pc.utf8_lower(texts.cast(pa.large_string())), "NFKD"))
    w = find_words(data, at)
    n = len(w.start)
    span = w.end - w.start
    symbols = _symbols(_take(data, w.start, span))
    word = np.repeat(np.arange(n), span)[symbols > 0]
    symbols = symbols[symbols > 0]
    sizes = np.bincount(word, minlength=n)
    first = np.cumsum(sizes) - sizes
    # hash of each word's symbols, then one entry per distinct word
    hashes = np.zeros(n, np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        place = np.arange(len(symbols)) - first[word]
        hashes[some] = mix(np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[place], first[some]))
    distinct, keep, number = np.unique(hashes, return_index=True, return_inverse=True)
    fresh = np.ones(n, bool)
    if n > 1:
        lines = np.cumsum(data == 10)
        fresh[1:] = _CLOSING[data[w.end[:-1] - 1]] | (lines[w.start[1:]] != lines[w.end[:-1] - 1]) | (w.text[1:] != w.text[:-1])
    sentence = np.flatnonzero(fresh)
    single = np.concatenate([[False], sizes == 1, [False]])
    begin, end = np.flatnonzero(single[1:] & ~single[:-1]), np.flatnonzero(single[:-1] & ~single[1:])
    long = end - begin >= 3
    spelled = [(int(b), symbols[first[b] : first[b] + e - b]) for b, e in zip(begin[long], end[long], strict=True)]
    spelled = [(b, s) for b, s in spelled if w.text[b] == w.text[b + len(s) - 1]]
    return Units(_take(symbols, first[keep], sizes[keep]), sizes[keep], distinct, number, sentence, w.text[sentence], w.text, spelled)


class Landmarks(NamedTuple):
    words: list[str]
    row: np.ndarray  # of each of CODES, in ``table`` (0: in no landmark)
    table: np.ndarray  # a line for each landmark
    typical: int  # the first so many are typical of toxic text

    def kernel(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Normalised kernel values of words (flat symbols, sizes) with each landmark."""
        out = np.zeros((len(self.table), len(sizes)), np.float32)
        symbols, word = bounded(symbols, sizes)
        square, words, rows, weights = np.zeros(len(sizes)), [], [], []
        for code, at, weight in subsequences(symbols, word):
            square += weight * weight * np.bincount(word[at], minlength=len(sizes))
            row = self.row[code]
            hit = np.flatnonzero(row)
            words.append(word[at[hit]])
            rows.append(row[hit])
            weights.append(np.full(len(hit), weight, np.float32))
        if not words:
            return out.T
        words, rows, weights = np.concatenate(words), np.concatenate(rows), np.concatenate(weights)
        order = np.argsort(words, kind="stable")
        words, rows, weights = words[order], rows[order], weights[order]
        for lo in range(0, len(words), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            cut = np.flatnonzero(np.diff(words[part], prepend=-1))
            at, row, weight = words[part][cut], rows[part], weights[part]
            # landmark by landmark, each word's values side by side: sums over columns of a table cost several times as much
            for line, to in zip(self.table, out, strict=True):
                to[at] += np.add.reduceat(line[row] * weight, cut)
        out /= np.maximum(np.sqrt(square), 1e-9).astype(np.float32)
        np.minimum(out, 1, out=out)
        np.power(out, POWER, out=out)
        return np.ascontiguousarray(out.T)


def bounded(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with each word's begin and end, and the word that each belongs to."""
    to = np.cumsum(sizes)
    at = np.concatenate([to, to - sizes])  # an end goes before the next word's begin
    marked = np.insert(symbols, at, np.repeat([END, BEGIN], len(sizes)))
    return marked, np.repeat(np.arange(len(sizes)), sizes + 2)


def codes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    exact = (a * 32 + b) * 32 + c
    large = np.flatnonzero((a | b | c) >= OTHER)
    if len(large):
        three = ((a[large].astype(np.uint64) << np.uint64(42)) | (b[large].astype(np.uint64) << np.uint64(21)) | c[large].astype(np.uint64))
        exact[large] = 32**3 + (mix(three * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(CODES - 32**3)).astype(np.int64)
    return exact


def subsequences(symbols: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Codes, places and weight of the three-letter subsequences of each shape that lie within one word."""
    for last in range(2, SPAN + 1):
        at = np.flatnonzero(word[last:] == word[:-last]) if len(word) > last else np.zeros(0, np.int64)
        if len(at):
            for middle in range(1, last):
                yield codes(symbols[at], symbols[at + middle], symbols[at + last]), at, DECAY**last


def symbols_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and sizes of words written as :func:`names_of` does."""
    points = np.array([ord(c) for x in words for c in x], np.int64)
    return np.where(points < 128, points - 96, points + OTHER), np.array([len(x) for x in words], np.int64)


def names_of(symbols: np.ndarray, sizes: np.ndarray) -> list[str]:
    text = np.where(symbols < OTHER, symbols + 96, symbols - OTHER).astype("<u4").tobytes().decode("utf-32-le")
    to = np.cumsum(sizes).tolist()
    return [text[b:e] for b, e in zip([0, *to[:-1]], to, strict=True)] if to else []


def landmarks(words: list[str], typical: int) -> Landmarks:
    symbols, word = bounded(*symbols_of(words))
    entries = [(c, word[p], np.full(len(c), x)) for c, p, x in subsequences(symbols, word)]
    code, of, weight = (np.concatenate(x) for x in zip(*entries, strict=True))
    used, place = np.unique(code, return_inverse=True)
    row = np.zeros(CODES, np.int64)
    row[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(words)), np.float32)
    np.add.at(table, (place + 1, of), weight)
    norm = np.sqrt(np.bincount(of, weight * weight, minlength=len(words)))
    return Landmarks(words, row, np.ascontiguousarray((table / np.maximum(norm, 1e-9).astype(np.float32)).T), typical)


class Remembered:
    """Kernel values of the words that a task met last, so that a word that comes up in batch after batch costs once."""

    def __init__(self, marks: Landmarks):
        self.marks, self.hashes, self.rows = marks, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.values = np.zeros((0, len(marks.words)), np.float32)

    def places(self, u: Units) -> np.ndarray:
        """The row in ``values`` of each distinct word, new ones added."""
        at = np.searchsorted(self.hashes, u.hashes)
        known = np.zeros(len(u.hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == u.hashes[inside]
        new = np.flatnonzero(~known)
        first = np.cumsum(u.sizes) - u.sizes
        fresh = self.marks.kernel(_take(u.symbols, first[new], u.sizes[new]), u.sizes[new])
        out = np.empty(len(u.hashes), np.int64)
        out[known] = self.rows[at[known]]
        if len(self.hashes) + len(new) > REMEMBERED:
            self.values = np.concatenate([self.values[out[known]], fresh])
            out[known] = np.arange(len(out) - len(new))
            out[new] = np.arange(len(out) - len(new), len(out))
            self.hashes, self.rows = u.hashes, out
        elif len(new):
            out[new] = np.arange(len(self.values), len(self.values) + len(new))
            self.values = np.concatenate([self.values, fresh])
            self.hashes, self.rows = np.insert(self.hashes, at[new], u.hashes[new]), np.insert(self.rows, at[new], out[new])
        return out

    def kernel(self, u: Units) -> np.ndarray:
        places = self.places(u)
        return self.values[places]


def highest(values: np.ndarray, number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of ``number`` (rows of ``values``; runs begin at ``first``), the highest of each column.

    Runs are cut in pieces of at most ``PIECE`` rows, and the k-th rows of all pieces are taken at once, longest pieces first.
    """
    n = np.diff(first, append=len(number))
    pieces = -(-n // PIECE)
    to = np.cumsum(pieces)
    at = np.arange(to[-1]) - np.repeat(to - pieces, pieces)
    start = np.repeat(first, pieces) + PIECE * at
    size = np.minimum(np.repeat(first + n, pieces) - start, PIECE)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    top = values[number[start]]
    for k in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -k))  # pieces of more than k rows
        np.maximum(top[:m], values[number[start[:m] + k]], out=top[:m])
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    out = top[back[to - pieces]]
    long = np.flatnonzero(pieces > 1)
    if len(long):
        rest = _take(back, (to - pieces)[long], pieces[long])
        out[long] = np.maximum.reduceat(top[rest], np.cumsum(pieces[long]) - pieces[long], axis=0)
    return out


def closest(u: Units, words: Remembered) -> np.ndarray:
    """For each sentence and landmark, the kernel value of the closest word."""
    marks = words.marks
    if not len(u.sentence):
        return np.zeros((0, len(marks.words)), np.float32)
    number = words.places(u)[u.number]
    out = np.zeros((len(u.sentence), len(marks.words)), np.float32)
    bounds = np.append(u.sentence, len(number))
    lo = 0
    while lo < len(u.sentence):  # about 64,000 words at once, or one sentence
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + (1 << 16), "right")) - 1)
        out[lo:hi] = highest(words.values, number[bounds[lo] : bounds[hi]], bounds[lo:hi] - bounds[lo])
        lo = hi
    if u.spelled:
        own = marks.kernel(np.concatenate([s for _, s in u.spelled]), np.array([len(s) for _, s in u.spelled]))
        np.maximum.at(out, np.searchsorted(u.sentence, [b for b, _ in u.spelled], "right") - 1, own)
    return out


class Model(NamedTuple):
    marks: Landmarks
    weight: np.ndarray  # on kernel values: Nyström map and separating plane in one
    bias: float
    slope: float
    offset: float

    def margins(self, z: np.ndarray) -> np.ndarray:
        return z @ self.weight + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM, classes weighing the same, by Newton steps on the rows inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * cost * 100
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(steps):
        a = x1[active] * share[active, None]
        w = np.linalg.solve(ridge + a.T @ x1[active], a.T @ sign[active])
        now = sign * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through weighted rows, targets drawn in as Platt does."""
    up, down = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    best = np.array([1.0, np.log((up + 1) / (down + 1))])
    loss = lambda w: (weight * (np.logaddexp(0, x @ w) - target * (x @ w))).sum()
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ best, -40, 40)))
        gradient = x.T @ (weight * (q - target))
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(best - size * step) > loss(best) - 1e-4 * size * (gradient @ step):
            size /= 2
        best = best - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return max(float(best[0]), 1e-3), float(best[1])


def typical_words(counts: list[tuple[str, int, int]], toxic: int, other: int, tested: int, rate: float = FALSE_DISCOVERY) -> list[str]:
    """Words of ``counts`` (word, documents of each label) that toxic documents have too often to be chance, surest first.

    One-sided binomial tails, and of ``tested`` words as many as the false discovery rate allows (Benjamini and Hochberg).
    """
    share = toxic / (toxic + other)

    def tail(k: int, n: int) -> float:
        """Logarithm of the chance of k or more of n."""
        at = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log(1 - share)
        term = total = 1.0
        for i in range(k, n):
            term *= (n - i) / (i + 1) * share / (1 - share)
            total += term
            if term < 1e-12 * total:
                break
        return at + math.log(total)

    rated = sorted((tail(k, k + o), word) for word, k, o in counts)
    last = max((i for i, (p, _) in enumerate(rated, 1) if p <= math.log(rate * i / max(tested, 1))), default=0)
    return [word for _, word in rated[:last]]


def _labelled_units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct word (of three symbols or more) of each labelled text."""
    for b in chunks(batches, most=BYTES):
        u = units(b.column("text"))
        names = np.array(names_of(u.symbols, u.sizes) or [""], object)
        pairs = np.unique(np.stack([u.word_text, u.number], 1), axis=0) if len(u.number) else np.zeros((0, 2), np.int64)
        pairs = pairs[u.sizes[pairs[:, 1]] >= 3] if len(pairs) else pairs
        labels = b.column("label").to_numpy(zero_copy_only=False)
        yield pa.record_batch(
            {"label": pa.array(labels[pairs[:, 0]], pa.int32()), "word": pa.array(names[pairs[:, 1]], pa.string())}
        )


def _sentences(marks: Landmarks, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Remembered(marks)
        for b in chunks(batches, most=BYTES):
            u = units(b.column("text"))
            z = closest(u, words)
            top = z[:, : marks.typical].max(1, initial=0)
            order = np.lexsort((-top, u.text))
            rank = np.arange(len(order)) - np.searchsorted(u.text[order], u.text[order])
            keep = order[rank < most]
            rows = [b.column(c).to_numpy(zero_copy_only=False)[u.text[keep]] for c in ("doc_id", "label")]
            yield pa.record_batch(
                {
                    "doc_id": pa.array(rows[0].astype(np.int64)),
                    "label": pa.array(rows[1].astype(np.int32)),
                    "z": lists(z[keep].ravel(), np.full(len(keep), z.shape[1]), pa.float32()),
                }
            )

    return run


def disguised(words: list[str], seed: int = 42) -> list[str]:
    """Each word with one letter inserted, and with several."""
    rng = np.random.default_rng(seed)
    out = []
    for x in words:
        letters = [chr(97 + k) for k in rng.integers(0, 26, len(x))]
        at = int(rng.integers(1, max(2, len(x))))
        out += [x[:at] + letters[0] + x[at:], x[:at] + letters[0] + x[at : at + 2] + letters[1] + x[at + 2 :]]
    return out


def machine(marks: Landmarks, nystroem: np.ndarray, hidden: np.ndarray, doc: np.ndarray, label: np.ndarray, z: np.ndarray) -> Model:
    """A separating plane between sentences, each toxic document's worst one against those of the others."""
    clean = np.flatnonzero(label == 0)
    hidden = np.maximum(hidden, z[clean[np.arange(len(hidden)) % len(clean)]])  # each in a clean sentence
    score = z[:, : marks.typical].max(1, initial=0)
    model = None
    for _ in range(3):
        order = np.lexsort((-score, doc))
        worst = order[np.unique(doc[order], return_index=True)[1]]
        picked = np.concatenate([clean, worst[label[worst] == 1]])
        x = np.vstack([z[picked], hidden])
        y = np.concatenate([label[picked], np.ones(len(hidden), int)])
        w, bias = support_vectors(x.astype(np.float64) @ nystroem, y)
        model = Model(marks, nystroem @ w, bias, 1.0, 0.0)
        score = model.margins(z)
    return model


def fit(marks: Landmarks, sure: list[str], doc: np.ndarray, label: np.ndarray, z: np.ndarray, counts: tuple[int, int]) -> Model:
    """A calibrated machine; ``counts`` tells how many labelled documents there are of label 0 and 1."""
    own = marks.kernel(*symbols_of(marks.words)).astype(np.float64)
    value, vector = np.linalg.eigh((own + own.T) / 2 + 1e-3 * np.eye(len(own)))
    nystroem = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    hidden = marks.kernel(*symbols_of(disguised(sure))) if sure else z[:0]
    docs, of = np.unique(doc, return_inverse=True)
    truth = np.zeros(len(docs), int)
    truth[of] = label
    # documents of each label in turn go to one half or the other
    half = np.zeros(len(docs), int)
    for y in (0, 1):
        half[truth == y] = np.arange((truth == y).sum()) % 2
    margin = np.full(len(docs), -np.inf)
    whole = machine(marks, nystroem, hidden, doc, label, z)
    split = all(((half == h) & (truth == y)).any() for h in (0, 1) for y in (0, 1))
    for h in (0, 1) if split else (None,):  # with one document of a label there is nothing to hold out
        seen, held = (half[of] != h, half[of] == h) if split else (np.ones(len(of), bool),) * 2
        model = machine(marks, nystroem, hidden, doc[seen], label[seen], z[seen]) if split else whole
        np.maximum.at(margin, of[held], model.margins(z[held]))
    weight = np.array([counts[y] * (1, MISS_COST)[y] / (truth == y).sum() for y in (0, 1)])[truth]
    slope, offset = platt(margin, truth, weight)
    return whole._replace(slope=slope, offset=offset)


def train(docs: DataFrame, labels: DataFrame, typical: int = TYPICAL, frequent: int = FREQUENT, per_label: int = PER_LABEL) -> Model | None:
    """A model from labels (doc_id, label of 0 or 1) and at most ``per_label`` documents of each."""
    # staged: the bounded sample is read for words and for sentences, its words for two lists and a count
    sample = staged(labelled_sample(docs, labels, per_label).withColumn("doc_id", F.monotonically_increasing_id()))
    words = staged(
        sample.mapInArrow(_labelled_units, "label int, word string").groupBy("word").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")
        )
    )
    n = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not n[0] or not n[1]:
        return None
    every = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    tested = words.where("toxic + other >= 3").count()
    # the strongest ones suffice: the list is short, and of words with one lift the commoner is surer
    p, q = (F.col("toxic") + 0.5) / (n[0] + 1), (F.col("other") + 0.5) / (n[1] + 1)
    rated = words.where(F.col("toxic") >= 3).withColumn("weight", p * F.log(p / q)).where("weight > 0")
    found = rated.orderBy(F.desc("weight"), "word").limit(20 * typical).collect()
    chosen = typical_words([(r.word, r.toxic, r.other) for r in found], n[0], n[1], tested)[:typical]
    common = words.where("other > toxic").orderBy(F.desc("other"), "word").limit(frequent).collect()
    if not chosen:
        return None
    marks = landmarks([*chosen, *[r.word for r in common if r.word not in chosen]], len(chosen))
    by = {r.word: r for r in found}
    sure = [w for w in chosen if by[w].other * n[0] <= 0.02 * by[w].toxic * n[1]]
    rows = sample.mapInArrow(_sentences(marks, SENTENCES), "doc_id long, label int, z array<float>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.z))
    of, label = np.array([r.doc_id for r in rows]), np.array([r.label for r in rows])
    if not len(label) or label.min() == label.max():
        return None
    return fit(marks, sure, of, label, np.array([r.z for r in rows], np.float32), (every[0], every[1]))


def _score(model: Model | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Remembered(model.marks) if model else None
        for b in chunks(batches, most=BYTES):
            out = np.full(b.num_rows, 0.5)
            if words:
                u = units(b.column("text"))
                margin = np.full(b.num_rows, model.bias)
                if len(u.sentence):
                    first = np.flatnonzero(np.diff(u.text, prepend=-1))
                    margin[u.text[first]] = np.maximum.reduceat(model.margins(closest(u, words)), first)
                out = model.probability(margin)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(out, pa.float64())})

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score (probability of being toxic) of every row."""
    return documents(docs).mapInArrow(_score(model), "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    taught = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("toxic").alias("label"))
    done = score(docs, train(docs, taught))
    return done.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
