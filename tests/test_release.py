import os

import pytest
from pyspark.sql import functions as F

import reqlens.plans.pipeline as P
from reqlens.sources.release import current_release, expired, new_version, publish_release, release_log
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from tests.conftest import SF001


def consistent(spark, root):
    """Rows of the current release, whose layers and summaries must all tell the same."""
    release = current_release(spark, root)
    if release is None:
        return None
    rows = {t: release.read(spark, t) for t in release.tables}
    n = rows["cleaned"].count()
    assert rows["transformed"].count() == n
    for t in rows:
        if t.endswith("summary"):
            assert rows[t].agg(F.sum("request_count")).first()[0] == n, t
    assert len({p.split("/")[1] for p in release.tables.values()}) == 1
    return n


STEPS = ("clean_stage", "transform_stage", "summary_stage", "publish_release")


@pytest.mark.parametrize("when", ["before", "after"])
def test_readers_see_one_whole_release_wherever_a_run_dies(spark, tmp_path, monkeypatch, when):
    root = str(tmp_path / "out")
    raw = raw_requests(spark, SF001)
    run = lambda df: P.run_pipeline(spark, df, root, spelling=CATEGORY_SPELLING, with_analyses=False)

    def dying(step):
        real = getattr(P, step)

        def dies(*args, **kwargs):
            if when == "after":
                real(*args, **kwargs)
            raise KeyboardInterrupt(step)

        return dies

    for step in STEPS:  # before the first release there is none
        with monkeypatch.context() as m:
            m.setattr(P, step, dying(step))
            with pytest.raises(KeyboardInterrupt):
                run(raw.where("unique_key % 2 = 0"))
        published = when == "after" and step == "publish_release"
        assert (consistent(spark, root) is not None) == published
    run(raw)
    whole = raw.count()
    assert consistent(spark, root) == whole
    part = raw.where("unique_key % 3 = 0")
    for step in STEPS:
        with monkeypatch.context() as m:
            m.setattr(P, step, dying(step))
            with pytest.raises(KeyboardInterrupt):
                run(part)
        published = when == "after" and step == "publish_release"
        assert consistent(spark, root) == (part.count() if published else whole)


def test_a_reader_keeps_what_it_resolved(spark, tmp_path):
    root = str(tmp_path / "r")
    for n in (3, 5):
        v = new_version(root)
        spark.range(n).write.parquet(f"{root}/{v}/t")
        release = publish_release(spark, root, v, {"t": f"{v}/t"})
        if n == 3:
            held = release
    assert held.read(spark, "t").count() == 3 and current_release(spark, root).read(spark, "t").count() == 5
    assert current_release(spark, root).number == 2


def test_tables_of_the_last_release_stay_and_old_versions_expire(spark, tmp_path):
    root = str(tmp_path / "r")
    versions = []
    for table in ("a", "b", "b", "b"):
        v = new_version(root)
        versions.append(v)
        spark.range(len(versions)).write.parquet(f"{root}/{v}/{table}")
        publish_release(spark, root, v, {table: f"{v}/{table}"}, keep=current_release(spark, root))
    now = current_release(spark, root)
    assert now.read(spark, "a").count() == 1 and now.read(spark, "b").count() == 4
    # versions[1] held a `b` that no recent release reads; versions[0] still holds `a`
    assert [r.version for r in expired(spark, root, keep=2).collect()] == [versions[1]]
    assert release_log(spark, root).count() == 1 + 2 * 3


def test_no_release(spark, tmp_path):
    assert current_release(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        release_log(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        P.publish_transformed(spark, str(tmp_path / "none"))


def test_an_unfinished_manifest_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "r")
    v = new_version(root)
    spark.range(1).write.parquet(f"{root}/{v}/t")
    publish_release(spark, root, v, {"t": f"{v}/t"})
    half = os.path.join(root, "manifests", "_temporary", "0")  # where a writer that was killed leaves its file
    os.makedirs(half)
    with open(os.path.join(half, "part-0.json"), "w") as f:
        f.write('{"release": 9, "version": "x", "tables": "{}"}')
    assert current_release(spark, root).number == 1
