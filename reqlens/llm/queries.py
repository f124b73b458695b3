"""Registered queries of the corpus operators, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reqlens.llm.chat_format import op13_chat_format
from reqlens.llm.decontamination import op2_benchmark_decontamination
from reqlens.llm.hard_negatives import op12_hard_negatives
from reqlens.llm.language_id import op3_language_id
from reqlens.llm.mixing import op9_source_mixing
from reqlens.llm.oracle import ORACLE
from reqlens.llm.prefix_trie import op11_prefix_trie
from reqlens.llm.quality_classifier import op6_quality_classifier
from reqlens.llm.quality_rules import op8_quality_rules
from reqlens.llm.secret_scan import op4_secret_scan
from reqlens.llm.simhash_dedup import op7_simhash_dedup
from reqlens.llm.substring_dedup import op1_substring_dedup
from reqlens.llm.toxicity import op10_toxicity
from reqlens.llm.warc_derivatives import op5_warc_derivatives

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_source_mixing": op9_source_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_chat_format": op13_chat_format,
}
