import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from reqlens.llm import language_id as L
from reqlens.llm import quality_classifier as Q
from reqlens.llm import toxicity as T
from reqlens.llm.common import bounded_sample, labelled_sample
from tests.conftest import SF01, SF001
from tests.llm.fixtures import awkward_rows, documents, texts, vocabulary


SF1 = "/root/testdata/sf0.1"


def held_out(got, truth, column):
    rows = [(r, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    return [(r[column], y) for r, y in rows]


def labels(spark, sf, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}


def test_language_held_out_accuracy_and_folds(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = L.op3_language_id(spark, SF001).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    pairs = held_out(got, truth, "lang_pred")
    assert sum(p == y for p, y in pairs) >= 0.95 * len(pairs)


def test_language_awkward_rows(spark):
    vocab = {"aa": vocabulary(50, 1), "bb": ["".join(reversed(w)) + "ø" for w in vocabulary(50, 2)]}
    rows = [(k, " ".join(random.Random(k).choices(vocab[g], k=30)), g, None, None) for k, g in enumerate(["aa", "bb"] * 20)]
    model = L.train(documents(spark, rows + [(99, "text", None, None, None), (98, None, "aa", None, None)], clashes=True))
    assert set(model.langs) == {"aa", "bb"}
    got = {r.doc_id: r for r in L.identify(documents(spark, rows, clashes=True), model).collect()}
    assert all(got[r[0]].lang_pred == r[2] and not got[r[0]].rejected for r in rows)
    odd = L.identify(documents(spark, awkward_rows(), clashes=True), model).collect()
    assert len(odd) == len(awkward_rows())
    by = {r.doc_id: r for r in odd}
    assert all((by[d].lang_pred, by[d].score, by[d].rejected) == ("und", 0.0, True) for d in (3, 4, 5, 9))
    assert by[1].lang_pred in ("aa", "bb")
    far = L.identify(documents(spark, [(1, "漢字仮名交じり文" * 20, None, None, None)]), model).first()
    assert far.rejected and far.lang_pred in ("aa", "bb")
    assert L.identify(documents(spark, []), model).count() == 0
    untaught = L.train(documents(spark, []))
    assert [r.lang_pred for r in L.identify(documents(spark, [(1, "text", None, None, None)]), untaught).collect()] == ["und"]


def test_unseen_languages_and_noise_are_rejected(spark):
    rng = random.Random(3)
    letters = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(150))
    odd = [
        "La mattina il vecchio pescatore usciva con la barca verso il largo mentre nel paese le donne preparavano il pane e i ragazzi andavano a scuola. " * 6,
        "Sabah erkenden kalkan yaşlı balıkçı teknesiyle denize açılırken köyde kadınlar ekmek yapıyor ve çocuklar okula yürüyorlardı. " * 6,
        "Rano stary rybak wypływał łodzią na pełne morze, a we wsi kobiety piekły chleb i dzieci szły do szkoły drogą na rynek. " * 6,
        "Aamulla vanha kalastaja lähti veneellään ulapalle, kun kylässä naiset leipoivat leipää ja lapset kävelivät kouluun. " * 6,
        letters,
        "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1200)),
        "x " * 300,
    ]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = L.train(docs.where(L.fold(docs["doc_id"], 4) != 2))
    got = L.identify(documents(spark, [(k, t, None, None, None) for k, t in enumerate(odd)]), model).collect()
    assert [r.doc_id for r in got if not r.rejected] == []
    held = L.identify(docs.where((L.fold(docs["doc_id"], 4) == 2) & docs["text"].rlike(r"\p{L}")), model).collect()
    assert sum(r.rejected for r in held) <= 0.01 * len(held)


def test_language_stage_keeps_rows_whole(spark):
    rows = [(k, t, "aa", "s", len(t)) for k, t in enumerate(texts(30, 40, vocabulary(60)))]
    df = documents(spark, [*rows, (None, None, None, None, None)], clashes=True)
    kept = L.accepted(df, L.train(df))
    assert kept.columns == df.columns
    assert sorted(tuple(r)[:5] for r in kept.collect()) == sorted(rows)


def test_ngram_counts_match_a_plain_count():
    names = ["Ab, c", "", "ÉTÉ 1", "a  b"]
    n, grams = L.counts(pa.array(names, pa.string()))
    for text, row, total in zip(["ab c", "", "été ", "a b"], n, grams, strict=True):
        raw = text.encode()
        assert row.sum() == total == sum(max(0, len(raw) - k + 1) for k in (1, 2, 3))


def test_quality_held_out_accuracy(spark):
    got = Q.op6_quality_classifier(spark, SF01).collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    pairs = held_out(got, labels(spark, SF01, "quality"), "predicted")
    assert sum(p == y for p, y in pairs) >= 0.9 * len(pairs)


def test_quality_awkward_rows(spark):
    df = documents(spark, awkward_rows(), clashes=True)
    vectors = Q.word_vectors(df)
    assert vectors.shape == (Q.TOKENS, Q.DIMS) and np.isfinite(vectors).all()
    assert {r.score for r in Q.score(df, None, vectors).collect()} == {0.5}
    taught = spark.createDataFrame([(1, 1), (2, 1), (4, 0), (6, 0), (6, 0), (None, 1), (3, None)], "doc_id long, label int")
    net = Q.train(df, taught, vectors)
    got = Q.score(df, net, vectors).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in got)
    assert Q.train(df, taught.where("label = 1"), vectors) is None
    assert Q.score(documents(spark, []), net, vectors).count() == 0


def test_context_sums_match_a_plain_loop():
    rng = np.random.default_rng(1)
    word, shape, text = rng.integers(0, 9, 40), Q.WORDS + rng.integers(0, 5, 40), np.sort(rng.integers(0, 4, 40))
    place, sign = Q.index_vectors()
    out = np.zeros(Q.TOKENS * Q.DIMS)
    Q.context_sums(word, shape, text, place, sign, out)
    want = np.zeros((Q.TOKENS, Q.DIMS))
    for i in range(40):
        for j in range(max(0, i - Q.SPAN), min(40, i + Q.SPAN + 1)):
            if i != j and text[i] == text[j]:
                for a in (word[i], shape[i]):
                    for b in (word[j], shape[j]):
                        for k in range(Q.SPARSE):
                            want[a, place[b, k]] += sign[b, k]
    assert np.allclose(out.reshape(want.shape), want)


def test_network_learns_and_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 2 * Q.DIMS)).astype(np.float32)
    y = ((x[:, 0] * x[:, 1] + 0.5 * rng.normal(size=1500)) > 0).astype(int)
    net = Q.train_network(x, y)
    p = net.probability(x)
    assert ((p >= 0.5) == y).mean() > 0.8 and net.temperature > 0
    assert Q.train_network(x, np.ones(1500, int)) is None


def naive_kernel(a, b):
    def entries(word):
        s = [T.BEGIN, *[ord(c) - 96 for c in word], T.END]
        return [((s[i], s[j], s[k]), T.DECAY ** (k - i)) for i in range(len(s)) for j in range(i + 1, len(s)) for k in range(j + 1, len(s)) if k - i <= T.SPAN]

    x, y = entries(a), entries(b)
    both = sum(u * v for p, u in x for q, v in y if p == q)
    norm = lambda e: sum(v * v for _, v in e) ** 0.5
    return min(both / (norm(x) * norm(y)), 1) ** T.POWER


def test_kernel_matches_a_plain_one():
    marks = T.landmarks(["idiot", "banana", "the"], 1)
    words = ["idiot", "idixot", "bananas", "x", "anab", "the"]
    got = marks.kernel(*T.symbols_of(words))
    want = [[naive_kernel(w, m) for m in marks.words] for w in words]
    assert np.allclose(got, want, atol=1e-5)


def test_units_split_sentences_and_spell_out():
    u = T.units(pa.array(["The i-d-i.o,t. no\nWay! i d i o t", None, "", "Ça 12"]))
    names = T.names_of(u.symbols, u.sizes)
    words = [names[k] for k in u.number]
    assert words == ["the", "idiot", "no", "way", "i", "d", "i", "o", "t", "ca", "{{"]
    assert u.sentence.tolist() == [0, 2, 3, 4, 9] and u.text.tolist() == [0, 0, 0, 0, 3]
    assert [T.names_of(s, np.array([len(s)]))[0] for _, s in u.spelled] == ["idiot"]


def insults(n, seed):
    rng = random.Random(seed)
    vocab, bad = vocabulary(300), ["idiotic", "scumbag", "moronic"]
    rows = []
    for d in range(n):
        parts = [" ".join(rng.choices(vocab, k=12)) + "." for _ in range(4)]
        if d % 4 == 0:
            parts[rng.randrange(4)] = " ".join([*rng.choices(vocab, k=5), rng.choice(bad), *rng.choices(vocab, k=5)]) + "!"
        rows.append((d, " ".join(parts), None, None, None))
    return rows


def test_toxicity_finds_disguised_words(spark):
    rows = insults(300, 1)
    taught = spark.createDataFrame([(r[0], int(r[0] % 4 == 0)) for r in rows], "doc_id long, label int")
    model = T.train(documents(spark, rows, clashes=True), taught)
    clean = " ".join(vocabulary(300)[:40])
    tests = {w: f"{clean}. {clean} {w} {clean}." for w in ("idiotic", "IDIOTIC", "idio-tic", "i d i o t i c", "idioxtic", "scumbqag", "moro.nic")}
    got = {r.doc_id: r.score for r in T.score(documents(spark, [(i, t, None, None, None) for i, t in enumerate([clean, *tests.values()])]), model).collect()}
    assert got[0] < 0.5
    assert all(got[i + 1] >= 0.5 for i in range(len(tests))), dict(zip(tests, list(got.values())[1:], strict=True))
    fresh = insults(200, 2)
    pred = {r.doc_id: r.score >= 0.5 for r in T.score(documents(spark, fresh), model).collect()}
    assert sum(pred[r[0]] == (r[0] % 4 == 0) for r in fresh) >= 196
    odd = T.score(documents(spark, awkward_rows(), clashes=True), model).collect()
    assert len(odd) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert T.score(documents(spark, []), model).count() == 0


@pytest.mark.parametrize("pairs", [[], [(1, 1), (2, 1)], [(1, None), (None, 0)]])
def test_toxicity_without_both_labels(spark, pairs):
    model = T.train(documents(spark, awkward_rows()), spark.createDataFrame(pairs, "doc_id long, label int"))
    assert model is None
    assert {r.score for r in T.score(documents(spark, awkward_rows()), model).collect()} == {0.5}


def test_toxicity_query_folds(spark):
    got = T.op10_toxicity(spark, SF001).collect()
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


@pytest.mark.parametrize("sf, caught", [(SF01, 0.5), (SF1, 0.85)])
def test_toxicity_held_out(spark, sf, caught):
    """Clean documents are left alone; most toxic ones are found (sf0.01 has six that are held out, and teaches English only)."""
    got = T.op10_toxicity(spark, sf).collect()
    pairs = held_out(got, labels(spark, sf, "toxic"), "predicted")
    clean, toxic = [p for p, y in pairs if y == 0], [p for p, y in pairs if y == 1]
    assert sum(clean) <= 0.05 * len(clean) and sum(toxic) >= caught * len(toxic)
    assert len(toxic) >= 5


def test_accidental_words_are_not_typical():
    counts = [("insult", 15, 0), ("often", 30, 200), ("chance", 3, 0)]
    assert T.typical_words(counts, 40, 280, 10_000) == ["insult"]
    assert T.typical_words(counts, 40, 280, 3) == ["insult", "chance"]
    assert T.typical_words([], 40, 280, 0) == []


CYRILLIC = "абвгдежзиклмнопрстуфхцчшщыэюя"


def test_other_scripts_are_learned(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices(CYRILLIC, k=rng.randint(3, 8))) for _ in range(300)]
    bad = ["придурок", "мерзавец"]
    rows = []
    for d in range(240):
        parts = [" ".join(rng.choices(words, k=12)).capitalize() + "." for _ in range(4)]
        if d % 4 == 0:
            parts[rng.randrange(4)] = " ".join([*rng.choices(words, k=5), rng.choice(bad), *rng.choices(words, k=5)]).upper() + "!"
        rows.append((d, " ".join(parts), None, None, None))
    taught = spark.createDataFrame([(r[0], int(r[0] % 4 == 0)) for r in rows[:160]], "doc_id long, label int")
    got = {r.doc_id: r.score >= 0.5 for r in T.score(documents(spark, rows), T.train(documents(spark, rows), taught)).collect()}
    assert sum(got[r[0]] == (r[0] % 4 == 0) for r in rows[160:]) >= 77
    same_length = T.landmarks(["придурок", "мерзавец"], 1).kernel(*T.symbols_of(["придурок", "караваны"]))
    assert same_length[0, 0] == pytest.approx(1) and same_length[1].max() < 0.1


def test_remembered_words_change_nothing(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 60)
    marks = T.landmarks(["idiot", "banana", "the"], 1)
    known = T.Remembered(marks)
    for k in range(6):
        u = T.units(pa.array(texts(5, 40, vocabulary(80), k)))
        assert np.array_equal(known.kernel(u), marks.kernel(u.symbols, u.sizes))


def test_highest_matches_a_plain_loop(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 4)
    rng = np.random.default_rng(6)
    sizes = np.array([1, 4, 5, 1, 37, 8, 2])
    values, number, first = rng.random((50, 3)).astype(np.float32), rng.integers(0, 50, sizes.sum()), np.cumsum(sizes) - sizes
    want = [values[number[a : a + n]].max(0) for a, n in zip(first, sizes, strict=True)]
    assert np.array_equal(T.highest(values, number, first), want)


def test_kernel_values_cost_less_than_sums_over_a_table():
    """The same values as rows of all landmarks, one for each subsequence, summed word by word, in less time."""
    marks = T.landmarks(vocabulary(100, 7), 80)
    symbols, sizes = T.symbols_of([a + b for a, b in zip(vocabulary(6000, 8), vocabulary(6000, 9), strict=True)])

    def plain():
        flat, word = T.bounded(symbols, sizes)
        parts = [(word[at], marks.row[code], np.full(len(at), weight, np.float32)) for code, at, weight in T.subsequences(flat, word)]
        words, rows, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
        square = np.bincount(words, weights.astype(np.float64) ** 2, len(sizes))
        order = np.argsort(words, kind="stable")
        order = order[rows[order] > 0]
        table, out = np.ascontiguousarray(marks.table.T), np.zeros((len(sizes), len(marks.words)), np.float32)
        for lo in range(0, len(order), 1 << 15):
            part = order[lo : lo + (1 << 15)]
            cut = np.flatnonzero(np.diff(words[part], prepend=-1))
            out[words[part][cut]] += np.add.reduceat(table[rows[part]] * weights[part, None], cut, axis=0)
        return np.minimum(out / np.maximum(np.sqrt(square), 1e-9)[:, None].astype(np.float32), 1) ** T.POWER

    def least(run):
        took = []
        for _ in range(3):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert np.allclose(marks.kernel(symbols, sizes), plain(), atol=1e-6)
    assert least(lambda: marks.kernel(symbols, sizes)) < 0.75 * least(plain)


# --- samples --------------------------------------------------------------------


def test_samples_are_drawn_by_row(spark):
    rows = [(None, t, lang, None, None) for lang in ("aa", "bb", "cc") for t in texts(100, 30, vocabulary(80), len(lang) + ord(lang[0]))]
    rows += [(7, t, "dd", None, None) for t in texts(100, 30, vocabulary(80), 99)] + [(7, "one text", "dd", None, None)] * 200 + [(8, "only", "ee", None, None)]
    df = documents(spark, rows).select("doc_id", "text", "lang")
    got = bounded_sample(df, "lang", 20).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"aa": 20, "bb": 20, "cc": 20, "dd": 20, "ee": 1}
    again = lambda: sorted(map(tuple, bounded_sample(df.repartition(7), "lang", 20).collect()), key=str)
    assert again() == again()


def test_labelled_samples_never_multiply(spark):
    rows = [(d % 40, t, None, None, None) for d, t in enumerate(texts(120, 30, vocabulary(80), 3))]
    rows += [(1, "hot", None, None, None)] * 300 + [(None, "no id", None, None, None)]
    taught = spark.createDataFrame([(d, int(d < 20)) for d in range(40)] * 5 + [(1, 0), (None, 1), (2, None)], "doc_id long, label int")
    got = labelled_sample(documents(spark, rows), taught, 30).collect()
    assert sorted({r.label for r in got}) == [0, 1] and len(got) == 60 and len({(r.doc_id, r.text) for r in got}) == 60
    assert all(r.label == int(r.doc_id < 20) for r in got)
    everything = labelled_sample(documents(spark, rows), taught, 10_000).collect()
    assert len(everything) == len({(r[0], r[1]) for r in rows if r[0] is not None})


def test_any_number_of_languages_is_learned(spark):
    rows = [(None, " ".join(random.Random(k).choices(vocabulary(40, k), k=12)), f"l{k}", None, None) for k in range(1100)]
    assert len(set(L.train(documents(spark, rows), centroids=1, per_language=2).langs)) == 1100
