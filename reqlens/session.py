"""Session settings the library relies on.

Only settings that are **unset** are filled in, so a cluster's own
configuration (shuffle partitions, checkpoint directory, ...) always wins.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession, checkpoint_dir: str | None = None) -> SparkSession:
    """Fill unset defaults; set a checkpoint directory only when the session has none."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the checkpoint directory that was set.

    Where neither is set, a local session gets one below its warehouse; on a cluster there is no
    folder to guess, so that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # one machine; local-cluster is not
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "reqlens") -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
