"""Clean and transform newly arriving raw files incrementally.

The per-row stages (parse, placeholders, flag, spelling, features) need no
state, so a file stream runs them unchanged.  Each micro-batch is gated with
the same fused one-job checks as the batch pipeline **before** it is
written, and written to its own ``batch_id=<n>`` directory with overwrite
semantics: a batch replayed after a failure replaces its own output instead
of appending twice.  Readers load ``out_dir`` as one table partitioned by
``batch_id``.

The checkpoint location must be on shared storage; by default it lives
under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.operators.gates import check_cleaning, check_transform
from reqlens.roles import CATEGORY_SPELLING, DEFAULT_ROLES, RAW_NUMERIC_TYPES, SOURCE_HEADER_ROLES, Roles
from reqlens.session import shared_folder
from reqlens.sources.files import cast_identifiers, csv_options, rename_to_roles, validate_columns
from reqlens.streaming.partials import add_summary_batch, summary_store


def raw_csv_stream(
    spark: SparkSession,
    source_dir: str,
    header_names: list[str],
    header_roles: Mapping[str, str] = SOURCE_HEADER_ROLES,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file stream of raw CSV exports (all text, like the batch reader), renamed to roles."""
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header_names])
    reader = spark.readStream.schema(schema).options(**csv_options())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = rename_to_roles(reader.csv(source_dir), header_roles)
    casts = {c: t for c, t in RAW_NUMERIC_TYPES.items() if c in df.columns}
    return cast_identifiers(df.withColumns({c: df[c].try_cast(t) for c, t in casts.items()}))


def _default_checkpoint(spark: SparkSession, name: str, out_dir: str) -> str:
    """Below the shared folder, by query name and output: streams of other outputs never meet in one checkpoint."""
    return f"{shared_folder(spark)}/{name}-{hashlib.sha256(out_dir.rstrip('/').encode()).hexdigest()[:12]}"


def start_incremental_transform(
    raw_stream: DataFrame,
    out_dir: str,
    checkpoint_location: str | None = None,
    spelling: Mapping[str, str] = CATEGORY_SPELLING,
    roles: Roles = DEFAULT_ROLES,
    available_now: bool = True,
    query_name: str = "reqlens_incremental_transform",
    summaries_dir: str | None = None,
) -> StreamingQuery:
    """Start the stream: raw -> cleaned -> transformed, gated per batch, one directory per batch.

    With ``summaries_dir`` each batch also adds its part of the four summaries there
    (:func:`reqlens.streaming.partials.stored_summaries` reads them).
    """
    validate_columns(raw_stream, roles)
    spark = raw_stream.sparkSession
    checkpoint_location = checkpoint_location or _default_checkpoint(spark, query_name, out_dir)
    transformed = transform_requests(clean_requests(raw_stream, spelling=spelling, roles=roles), roles=roles)
    out_dir = out_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one micro-batch is bounded by the trigger; keep it for the gates and the write
        batch = batch.persist()
        try:
            check_cleaning(batch, spelling=spelling, roles=roles)
            check_transform(batch, roles=roles)
            batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
            if summaries_dir:
                add_summary_batch(summary_store(summaries_dir), batch, batch_id, roles)
        finally:
            batch.unpersist()

    writer = (
        transformed.writeStream.queryName(query_name)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
