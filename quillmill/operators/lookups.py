"""Reads of the stored tables: by key, in pages, along foreign keys."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value
PAGE_LIMIT = 100


def by_key(df: DataFrame, **values: Any) -> DataFrame:
    """Rows equal in all named columns; the comparison is pushed to the scan."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def first_by(df: DataFrame, **values: Any) -> DataFrame:
    """At most one row equal in all named columns."""
    return by_key(df, **values).limit(1)


def page(df: DataFrame, order: str, skip: int = 0, limit: int = PAGE_LIMIT) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` by ``order``."""
    return df.orderBy(order).offset(skip).limit(limit)


def pending(queue: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """The first waiting rows of the ingest queue."""
    return queue.filter(F.col("status") == "pending").orderBy("ingest_id").limit(limit)


def seen_before(hits: DataFrame, works: DataFrame, search_hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hits seen and not seen: by DOI among the works, or without a DOI by URL among the search hits."""
    has_doi = F.col("doi").isNotNull() & (F.col("doi") != "")
    dois = works.select("doi").distinct()
    urls = search_hits.select("url").distinct()
    with_doi, without = hits.filter(has_doi), hits.filter(~has_doi)
    seen = with_doi.join(dois, "doi", "left_semi").unionByName(without.join(urls, "url", "left_semi"))
    fresh = with_doi.join(dois, "doi", "left_anti").unionByName(without.join(urls, "url", "left_anti"))
    return seen.select(*hits.columns), fresh.select(*hits.columns)


def work_tree(works: DataFrame, files: DataFrame, chunks: DataFrame, file_summaries: DataFrame, queue: DataFrame) -> DataFrame:
    """Per file of a work: its summary, and how many chunks and queue rows it has.

    Children are counted before the join, so a file with very many chunks joins as one row.
    """
    n_chunks = chunks.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    n_jobs = queue.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_jobs"))
    joined = works.join(files, "work_id").join(file_summaries.select("file_id", "kind", "summary_text"), "file_id", "left")
    joined = joined.join(n_chunks, "file_id", "left").join(n_jobs, "file_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_chunks", "n_jobs")})
