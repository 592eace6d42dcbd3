"""The queries of this subpackage, each over its whole table, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import (
    decontam, lm, mixing, neardup, negatives, oracle, passages, pieces, pii, quality, repair, repetition, secrets, toxicity,
)
from quillmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_repetition(spark: SparkSession, folder: str) -> DataFrame:
    rules = repetition.quality_rules(table(spark, folder, "documents"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.removed_passages(table(spark, folder, "documents"))


def op4_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_scores(table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op7_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).drop("row_key")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Repositories are the languages of a source, its owner."""
    return secrets.secret_scan(table(spark, folder, "documents"))


def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_digests(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_report(table(spark, folder, "conversations"))


def op13_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_repetition, op3_passages, op4_decontam, op5_lm, op6_pii, op7_neardup, op8_secrets, op9_pieces, op10_quality,
    op11_negatives, op12_repair, op13_mix,
)}
SQL: dict[str, str] = dict(oracle.SQL)
