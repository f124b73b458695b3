"""Corpus pipeline: each stage calls one operator on all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents.  All but the last return the
columns of documents.  All stages decide row by row, also where rows share a doc_id or
have none.  No stage drops a row for a NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm import decontamination, language_id, mixing, secret_scan, simhash_dedup
from reqlens.llm.common import fold, load, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, out: DataFrame) -> DataFrame:
    gone = out.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def _by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row as doc_id and its own doc_id as _id; staged, so that the keys stay."""
    return staged(docs.withColumns({"_id": F.col("doc_id"), "doc_id": F.monotonically_increasing_id()}))


def _own_ids(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("_id")).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no letters, or too far from every centroid."""
    model = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    return language_id.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row stays: the one with the smallest doc_id, of those that share it the first."""
    rows = _by_row(docs)
    found = simhash_dedup.near_duplicates(rows)
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "doc_id")
    stays = rows.select("_id", "doc_id").join(found, "doc_id").groupBy("component_id").agg(F.min(order).alias("first"))
    return _own_ids(rows.join(stays.select(F.col("first.doc_id").alias("doc_id")), "doc_id", "left_semi"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a phrase of a benchmark item go."""
    rows = _by_row(docs)
    found = decontamination.contamination(rows, load(spark, sf_dir, "benchmark"))
    return _own_ids(_without(rows, found.where("n_hit > 0")), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in their documents, and n_chars follows."""
    model = secret_scan.train(secret_scan.labelled_findings(docs))
    # what is masked follows from the text alone, so its hash is key enough: no copy of the table is kept for one
    rows = docs.withColumns({"_id": F.col("doc_id"), "doc_id": F.xxhash64("text")})
    masked = _own_ids(secret_scan.redacted(rows, secret_scan.scan(rows, model)), docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: A trained model and XXH64 fingerprints decide on rows, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
