"""Rates, counts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.operators.documents import CHUNK_CHARS, extractive_summaries


def resolution_rate(resolved: DataFrame) -> DataFrame:
    """One row ``(total, resolved, success_rate)`` with the rate in percent; NULL when there are no hits."""
    counts = resolved.agg(F.count(F.lit(1)).alias("total"), F.count("pdf_url").alias("resolved"))
    return counts.withColumn("success_rate", F.try_divide("resolved", "total") * 100)


def unique_items(df: DataFrame, key: str = "pdf_url") -> DataFrame:
    return df.select(key).distinct().agg(F.count(key).alias("unique_items"))


def dedup_ratio(df: DataFrame, key: str) -> DataFrame:
    """One row ``(before, after, kept_ratio)``.

    Distinct values are counted per group first, so the shuffle carries one row per value and task.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before"), F.count(key).alias("after"))
    return totals.withColumn("kept_ratio", F.try_divide("after", "before"))


def text_stats(df: DataFrame, text: str, group: str) -> DataFrame:
    """Documents, characters and chunks per group."""
    chars = F.length(text).cast("bigint")
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(chars).alias("chars"),
        F.max(chars).alias("longest"),
        F.sum(F.ceil(chars / CHUNK_CHARS)).alias("chunks"),
    )


def stage_dashboard(stage_log: DataFrame) -> DataFrame:
    """Per stage: items, successes, the success rate in percent and the last time."""
    return stage_log.groupBy("stage").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if("ok").alias("succeeded"),
        (F.avg(F.col("ok").cast("double")) * 100).alias("success_rate"),
        F.max("at").alias("last_at"),
    )


def top_papers(papers: DataFrame, k: int) -> DataFrame:
    """Per topic the ``k`` most relevant papers with their ``rank``, newer first among equals. Every task sends on ``k`` per topic at most."""
    best = Window.partitionBy("topic").orderBy(F.desc("score"), F.desc_nulls_last("year"), "paper_id")
    return papers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def topic_digest(papers: DataFrame, summaries: DataFrame, k: int = 3, kind: str = "executive") -> DataFrame:
    """Per topic the ``top_papers`` with their summary, which is joined to those only.

    ``papers`` has ``topic, paper_id, title, year, score``.
    """
    texts = summaries.filter(F.col("summary_type") == kind).select("paper_id", "content")
    entries = top_papers(papers, k).join(texts, "paper_id", "left")
    entry = F.struct("rank", "paper_id", "title", "year", "score", "content")
    return entries.groupBy("topic").agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def topic_digest_of_texts(papers: DataFrame, texts: DataFrame, k: int = 3, kind: str = "executive") -> DataFrame:
    """The same from ``(paper_id, text)``: only the texts of top papers are summarised."""
    wanted = texts.join(top_papers(papers, k).select("paper_id").distinct(), "paper_id", "left_semi")
    return topic_digest(papers, extractive_summaries(wanted, "text", "paper_id"), k, kind)
