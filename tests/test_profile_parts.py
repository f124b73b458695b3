import itertools
import random

import pytest
from pyspark.sql import functions as F

from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.operators.summaries import split_summary_groups, summary_groups
from reqlens.plans import profile as PR
from reqlens.plans.pipeline import PROFILE_CHECKS
from reqlens.sources.files import read_raw_csv
from reqlens.streaming import partials as S
from reqlens.streaming.incremental import raw_csv_stream, start_incremental_transform
from tests.fixtures import HEADERS, raw_csv_text, write_raw_csv


def same(got, want):
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    df = read_raw_csv(spark, write_raw_csv(str(tmp_path_factory.mktemp("parts"))))
    path = str(tmp_path_factory.mktemp("parts") / "raw")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_fused_profile_equals_each_check(spark, raw, tmp_path):
    got = PR.fused_profile(spark, raw, str(tmp_path / "p"))
    assert set(got) == set(PROFILE_CHECKS)
    for name, check in PROFILE_CHECKS.items():
        same(got[name], check(raw))


def test_fused_profile_of_an_empty_and_of_a_narrow_table(spark, raw, tmp_path):
    narrow = raw.drop("latitude", "incident_zip", "agency_name", "resolution_updated", "detail")
    got = PR.fused_profile(spark, narrow, str(tmp_path / "narrow"))
    for name in ("missing_profile", "unparseable_dates", "placeholder_totals", "missing_zip_count", "coord_mismatch_rows", "agency_name_consistency"):
        same(got[name], PROFILE_CHECKS[name](narrow))
    got = PR.fused_profile(spark, raw.limit(0), str(tmp_path / "empty"))
    for name in ("structure_profile", "date_range", "missing_profile", "placeholder_totals", "duplicate_keys", "status_counts", "quality_counts", "blank_agencies"):
        same(got[name], PROFILE_CHECKS[name](raw.limit(0)))


def batches(df):
    return {k: df.where(F.pmod("unique_key", F.lit(3)) == k) for k in range(3)}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 0, 2)])
def test_batches_in_any_order_with_replays_equal_the_whole(spark, raw, tmp_path, order):
    at = PR.Layout.of(raw)
    store = S.profile_store(str(tmp_path / "s"), at)
    of = batches(raw)
    with pytest.raises(FileNotFoundError):
        store.read(spark)
    added = [S.add_profile_batch(store, of[k], k, at) for k in order]
    assert sum(added) == 3 and store.done(spark) == {0, 1, 2}
    got = S.stored_profile(spark, store, at)
    for name in ("missing_profile", "date_range", "status_counts", "duplicate_keys", "full_row_duplicates", "invalid_date_rows"):
        same(got[name], PROFILE_CHECKS[name](raw))


def test_a_batch_that_dies_on_its_way_does_not_count(spark, raw, tmp_path):
    at, of = PR.Layout.of(raw), batches(raw)
    store = S.profile_store(str(tmp_path / "s"), at)
    S.add_profile_batch(store, of[0], 0, at)
    rows = lambda: S.stored_profile(spark, store, at)["structure_profile"].first().row_count
    before = rows()

    for last in PR.PARTS:  # dies after this part

        def dying(write, last=last):
            def stops(name, part):
                write(name, part)
                if name == last:
                    raise KeyboardInterrupt(name)

            PR.write_parts(of[1], at, stops)

        with pytest.raises(KeyboardInterrupt):
            store.add(spark, 1, dying)
        assert rows() == before
    assert S.add_profile_batch(store, of[1], 1, at) and rows() == before + of[1].count()


def test_compaction_changes_no_result(spark, raw, tmp_path, monkeypatch):
    at, of = PR.Layout.of(raw), batches(raw)
    store = S.profile_store(str(tmp_path / "s"), at)
    names = ("status_counts", "duplicate_keys")
    read = lambda: {n: sorted(map(repr, S.stored_profile(spark, store, at)[n].collect())) for n in names}
    S.add_profile_batch(store, of[0], 0, at)
    S.add_profile_batch(store, of[1], 1, at)
    before = read()
    with monkeypatch.context() as m:  # dies before the new set is published
        m.setattr(S, "publish_release", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.compact(spark)
    assert read() == before and store.done(spark) == {0, 1}
    assert store.compact(spark) == 2 and read() == before and store.done(spark) == set()
    assert not S.add_profile_batch(store, of[0], 0, at) and read() == before  # replayed after it was compacted
    S.add_profile_batch(store, of[2], 2, at)
    assert store.compact(spark) == 1 and store.compact(spark) == 0
    got = S.stored_profile(spark, store, at)
    for n in (*names, "missing_profile", "date_range", "coord_mismatch_rows"):
        same(got[n], PROFILE_CHECKS[n](raw))


def test_maintained_summaries_equal_the_batch_ones(spark, raw, tmp_path):
    transformed = transform_requests(clean_requests(raw))
    want = split_summary_groups(summary_groups(transformed))
    rng = random.Random(3)
    for k in range(2):
        store = S.summary_store(str(tmp_path / f"s{k}"))
        order = list(itertools.chain(batches(transformed).items()))
        rng.shuffle(order)
        for i, (batch_id, df) in enumerate(order):
            S.add_summary_batch(store, df, batch_id)
            if k and i == 1:
                store.compact(spark)
        got = S.stored_summaries(spark, store)
        for name in want:
            assert list(map(tuple, got[name].collect())) == list(map(tuple, want[name].collect())), name


def test_streams_keep_profile_and_summaries(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    header, *body = raw_csv_text().splitlines()
    for i in range(3):
        (src / f"part{i}.csv").write_text("\n".join([header, *body[i::3]]) + "\n")
    stream = lambda: raw_csv_stream(spark, str(src), HEADERS, max_files_per_trigger=1)
    raw = read_raw_csv(spark, str(src))
    root = str(tmp_path / "profile")
    q = S.start_incremental_profile(stream(), root, str(tmp_path / "c1"))
    q.awaitTermination(300)
    assert q.exception() is None
    at = PR.Layout.of(stream())
    got = S.stored_profile(spark, S.profile_store(root, at), at)
    for name in ("status_counts", "duplicate_keys", "quality_counts"):
        same(got[name], PROFILE_CHECKS[name](raw))
    q = start_incremental_transform(stream(), str(tmp_path / "t"), str(tmp_path / "c2"), summaries_dir=str(tmp_path / "sums"))
    q.awaitTermination(300)
    assert q.exception() is None
    want = split_summary_groups(summary_groups(transform_requests(clean_requests(raw))))
    for name, df in S.stored_summaries(spark, S.summary_store(str(tmp_path / "sums"))).items():
        same(df, want[name])
