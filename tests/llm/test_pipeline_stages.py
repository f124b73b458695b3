"""Each stage of the corpus pipeline against a plain version on a small corpus."""

import random

import corpus_pipeline as P
from tests.conftest import SF001
from tests.llm.fixtures import DOCUMENTS, documents, texts, vocabulary
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash_dedup import named


def corpus(spark):
    rng = random.Random(11)
    bench = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    vocab = vocabulary(400)
    rows = [(d, t, "en", rng.choice("abc"), len(t)) for d, t in enumerate(texts(60, 150, vocab))]
    rows += [(100 + k, rows[k][1], "en", "a", 1) for k in range(20)]  # copies
    rows += [(200 + k, f"{rows[k][1]} {bench[k]}", "en", "b", 1) for k in range(5)]  # leaks
    rows += [(300, None, None, None, None), (301, "12 34", "en", "c", 5), (302, f"{rows[30][1]} password=b7db7aa4a5fcc78305 x", "en", "c", 1), (None, rows[40][1], "en", "a", 1)]
    return rows


def test_stages_match_plain_versions(spark):
    rows = corpus(spark)
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "secret scans", "mixing sources to target weights"]
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    df = documents(spark, rows)
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    first = stages["language ID"](spark, df, SF001)
    assert ids(first) == sorted(str(r[0]) for r in lettered) and first.columns == [f.name for f in DOCUMENTS]

    df = documents(spark, lettered)
    inorder = sorted(lettered, key=lambda r: (r[0] is None, r[0] or 0))
    first_of = {i: c for i, _, c in named([(i, r[1]) for i, r in enumerate(inorder)], 2)}
    second = stages["SimHash near-dedup"](spark, df, SF001)
    assert ids(second) == sorted(str(r[0]) for i, r in enumerate(inorder) if first_of[i] == i)
    assert second.columns == df.columns

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in brute([r[:2] for r in lettered], items, 10) if not hit}
    third = stages["benchmark decontamination"](spark, df, SF001)
    assert ids(third) == sorted(str(r[0]) for r in lettered if r[0] in clean) and third.columns == df.columns

    fourth = stages["secret scans"](spark, df, SF001)
    after = {r.doc_id: r for r in fourth.collect()}
    assert len(after) == len(lettered) and fourth.columns == df.columns
    for r in lettered:
        want = r[1].replace("b7db7aa4a5fcc78305", "[SECRET]")
        assert after[r[0]].text == want and after[r[0]].n_chars == len(want)

    fifth = stages["mixing sources to target weights"](spark, df, SF001).collect()
    assert len(fifth) == len(lettered) and all(0 <= r.taken <= 3 * r["size"] for r in fifth)


def test_rows_without_or_with_one_id_are_decided_alone(spark):
    stages = dict(P.STAGES)
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").first().text
    plain = texts(40, 60, vocabulary(400))
    secret = "b7db7aa4a5fcc78305"
    rows = [(d, t, "en", "a", 1) for d, t in enumerate(plain)]
    odd = [(d, t, "en", "b", 1) for d in (None, 900) for t in (f"{plain[0]} {bench}", f"{plain[1]} clean", f"{plain[2]} password={secret} x")]
    df = documents(spark, rows + odd)
    third = sorted((str(r.doc_id), r.text) for r in stages["benchmark decontamination"](spark, df, SF001).where("source = 'b'").collect())
    assert third == sorted((str(r[0]), r[1]) for r in odd if bench not in r[1])
    fourth = sorted((str(r.doc_id), r.text) for r in stages["secret scans"](spark, df, SF001).where("source = 'b'").collect())
    assert fourth == sorted((str(r[0]), r[1].replace(secret, "[SECRET]")) for r in odd)


def test_one_row_of_each_component_stays(spark):
    stage = dict(P.STAGES)["SimHash near-dedup"]
    one, two = texts(2, 60, vocabulary(400), 4)
    rows = [(d, one, "en", "a", 1) for d in (1, 1, None, None, 2)] + [(None, two, "en", "a", 1)] * 3 + [(None, None, None, None, None)] * 2
    got = sorted(((r.doc_id, r.text) for r in stage(spark, documents(spark, rows), SF001).collect()), key=str)
    assert got == sorted([(1, one), (None, two), (None, None)], key=str)


def test_run_applies_all_stages(spark):
    got = P.run(spark, SF001).collect()
    assert 0 < len(got) <= 200 and {"doc_id", "taken", "target"} <= set(got[0].asDict())


def test_stages_take_an_empty_corpus(spark):
    for _, stage in P.STAGES:
        assert stage(spark, documents(spark, []), SF001).count() == 0
