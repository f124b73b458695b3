"""Results kept up to date from the parts of arriving batches.

Each batch is looked at once.  What it adds, its *parts* (counts, sums, bounds; see :mod:`reqlens.plans.profile` and
:func:`reqlens.operators.summaries.summary_groups`), is stored under the batch's id, and readers merge the parts of all
batches.  Parts merge in any order, so batches may arrive in any.

::

    root/batches/<part>/batch_id=<n>/...    the parts of one batch
    root/done/batch_id=<n>/...              written last: the batch counts from then on
    root/versions, root/manifests           compacted parts (reqlens.sources.release)

A batch that is killed on its way is not yet done, and its replay overwrites what it left; a batch that is done is
skipped when it is replayed, so it never counts twice.  :meth:`PartStore.compact` merges all done batches into one
set of parts and publishes that in one step together with the list of batches in it; readers see either the
batches or the set they went into.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reqlens.operators.summaries import split_summary_groups, summary_groups
from reqlens.plans.profile import PARTS, Layout, checks, merged, write_parts
from reqlens.roles import DEFAULT_ROLES, Roles
from reqlens.session import shared_folder
from reqlens.sources.release import current_release, new_version, publish_release

#: The table of a compacted set that lists the batches in it.
MERGED = "merged_batches"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


@dataclass(frozen=True)
class PartStore:
    """Parts of batches under ``root``; ``merge`` puts the parts of several sets of rows together."""

    root: str
    parts: tuple[str, ...]
    merge: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]

    def done(self, spark: SparkSession) -> set[int]:
        """Batches that count and are not compacted yet (an id per batch reaches the driver)."""
        marks = _read(spark, f"{self.root}/done")
        ids = {r[0] for r in marks.select("batch_id").distinct().collect()} if marks is not None else set()
        return ids - self._merged(spark)

    def _merged(self, spark: SparkSession) -> set[int]:
        release = current_release(spark, self.root)
        return {r[0] for r in release.read(spark, MERGED).collect()} if release else set()

    def add(self, spark: SparkSession, batch_id: int, write: Callable[[Callable[[str, DataFrame], None]], None]) -> bool:
        """Store a batch: ``write`` gets a function (part, rows) to call for each part.  False if the batch was done before."""
        if batch_id in self.done(spark) | self._merged(spark):
            return False
        write(lambda name, part: part.write.mode("overwrite").parquet(f"{self.root}/batches/{name}/batch_id={batch_id}"))
        spark.range(1).select("id").write.mode("overwrite").parquet(f"{self.root}/done/batch_id={batch_id}")
        return True

    def _stored(self, spark: SparkSession, ids: Iterable[int]) -> dict[str, DataFrame]:
        ids, release, out = sorted(ids), current_release(spark, self.root), {}
        for name in self.parts:
            of = []
            if release:
                of.append(release.read(spark, name))
            if ids:  # a filter on the partition column reads the directories of these batches alone
                of.append(spark.read.parquet(f"{self.root}/batches/{name}").where(F.col("batch_id").isin(ids)).drop("batch_id"))
            if not of:
                raise FileNotFoundError(f"no batch under {self.root}")
            out[name] = of[0] if len(of) == 1 else of[0].unionByName(of[1])
        return out

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The parts of all batches, merged."""
        return self.merge(self._stored(spark, self.done(spark)))

    def compact(self, spark: SparkSession) -> int:
        """Merge all done batches into the compacted set; how many there were."""
        ids = self.done(spark)
        if not ids:
            return 0
        version = new_version(self.root)
        tables = {}
        for name, part in self.merge(self._stored(spark, ids)).items():
            tables[name] = f"{version}/{name}"
            part.write.parquet(f"{self.root}/{tables[name]}")
        every = sorted(ids | self._merged(spark))
        tables[MERGED] = f"{version}/{MERGED}"
        spark.createDataFrame([(i,) for i in every], "batch_id long").write.parquet(f"{self.root}/{tables[MERGED]}")
        publish_release(spark, self.root, version, tables)
        return len(ids)


# --- quality profile -----------------------------------------------------------------


def profile_store(root: str, at: Layout) -> PartStore:
    return PartStore(root.rstrip("/"), PARTS, lambda parts: merged(parts, at))


def add_profile_batch(store: PartStore, batch: DataFrame, batch_id: int, at: Layout) -> bool:
    return store.add(batch.sparkSession, batch_id, lambda write: write_parts(batch, at, write))


def stored_profile(spark: SparkSession, store: PartStore, at: Layout) -> dict[str, DataFrame]:
    """Every check of the profile over all batches so far."""
    return checks(store.read(spark), at)


def start_incremental_profile(
    raw_stream: DataFrame, root: str, checkpoint_location: str | None = None, roles: Roles = DEFAULT_ROLES
) -> StreamingQuery:
    """Profile a raw stream batch by batch; :func:`stored_profile` reads it at any time."""
    at = Layout.of(raw_stream, roles)
    store = profile_store(root, at)
    where = checkpoint_location or f"{shared_folder(raw_stream.sparkSession)}/profile-checkpoint/{store.root.strip('/').replace('/', '-')}"
    writer = raw_stream.writeStream.foreachBatch(lambda batch, batch_id: add_profile_batch(store, batch, batch_id, at) and None)
    return writer.option("checkpointLocation", where).trigger(availableNow=True).start()


# --- summaries ---------------------------------------------------------------------------


def _merge_summaries(parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    groups = parts["groups"]
    sums = ("request_count", "_sum_h", "_n_h")
    return {"groups": groups.groupBy(*[c for c in groups.columns if c not in sums]).agg(*[F.sum(c).alias(c) for c in sums])}


def summary_store(root: str) -> PartStore:
    """Counts and sums in hundredths for each value of each summary's key."""
    return PartStore(root.rstrip("/"), ("groups",), _merge_summaries)


def add_summary_batch(store: PartStore, transformed: DataFrame, batch_id: int, roles: Roles = DEFAULT_ROLES) -> bool:
    return store.add(transformed.sparkSession, batch_id, lambda write: write("groups", summary_groups(transformed, roles)))


def stored_summaries(spark: SparkSession, store: PartStore, roles: Roles = DEFAULT_ROLES) -> dict[str, DataFrame]:
    """The four summaries over all batches so far: means are exact, as they come from sums and counts."""
    return split_summary_groups(store.read(spark)["groups"], roles)
