"""Tables that change together: versioned directories and a log of manifests.

::

    root/versions/<version>/<table>/...     written once, never changed
    root/manifests/part-*.json              one file per release: its number, and the path of each of its tables

A release is first written whole into a version of its own.  It comes into being when its manifest, a single
file, is committed by Spark's own writer; the file appears under its final name in one step.  Readers take the tables of
the newest manifest.  So whatever step a writer is killed at, readers see the last release or the new one, each whole,
and a reader that has resolved its paths keeps them, as no version is ever changed.

Nothing is renamed, replaced or deleted here, which works alike on HDFS and on object stores.
:func:`expired` names the versions that no recent release uses; a failed run's are among them.
Writers are expected one at a time; of two at once the later manifest wins, whole.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "release long, version string, tables string"


@dataclass(frozen=True)
class Release:
    """A published set of tables: name -> path, relative to the root."""

    root: str
    number: int
    version: str
    tables: Mapping[str, str]

    def path(self, table: str) -> str:
        if table not in self.tables:
            raise FileNotFoundError(f"no table {table} in release {self.number} of {self.root}")
        return f"{self.root}/{self.tables[table]}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).json(f"{root}/manifests")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def current_release(spark: SparkSession, root: str) -> Release | None:
    """The newest release under ``root``, or None before the first."""
    root = root.rstrip("/")
    log = _manifests(spark, root)
    row = log.orderBy(F.desc("release"), F.desc("version")).first() if log is not None else None
    return Release(root, row["release"], row["version"], json.loads(row["tables"])) if row else None


def new_version(root: str) -> str:
    """A fresh directory name below ``root``, later ones sorting after earlier ones."""
    return f"versions/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


def publish_release(spark: SparkSession, root: str, version: str, tables: Mapping[str, str], keep: Release | None = None) -> Release:
    """Make ``tables`` (name -> path below ``root``) the current release in one step.

    Tables of ``keep`` that this release does not write stay in it.
    """
    root = root.rstrip("/")
    last = current_release(spark, root)
    number = (last.number if last else 0) + 1
    merged = {**(keep.tables if keep else {}), **tables}
    line = spark.range(1).select(
        F.lit(number).cast("long").alias("release"), F.lit(version).alias("version"), F.lit(json.dumps(merged)).alias("tables")
    )
    line.coalesce(1).write.mode("append").json(f"{root}/manifests")
    return Release(root, number, version, merged)


def release_log(spark: SparkSession, root: str) -> DataFrame:
    """``release, version, table_name, path`` of every release so far."""
    log = _manifests(spark, root.rstrip("/"))
    if log is None:
        raise FileNotFoundError(f"no release under {root}")
    return log.select("release", "version", F.explode(F.from_json("tables", "map<string,string>")).alias("table_name", "path"))


def expired(spark: SparkSession, root: str, keep: int = 2) -> DataFrame:
    """``version`` of releases that none of the last ``keep`` releases reads from: for a lifetime rule to delete."""
    log = release_log(spark, root)
    newest = log.agg(F.max("release").alias("_newest"))
    used = log.join(F.broadcast(newest), F.col("release") > F.col("_newest") - keep)  # one row
    recent = used.select(F.regexp_extract("path", "^(versions/[^/]+)", 1).alias("version")).distinct()
    return log.select("version").distinct().join(recent, "version", "left_anti")
