"""Topic to stored papers as one batch job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import dedupe, hits, resolve
from quillmill.operators.hits import Provider
from quillmill.streaming.jobs import IngestFlow


def find_papers(
    spark: SparkSession,
    topics: DataFrame,
    providers: Sequence[Provider],
    oa_snapshot: DataFrame,
    pmc_snapshot: DataFrame,
) -> DataFrame:
    """Expand topics, search, merge by DOI, resolve, and keep one hit per full-text URL."""
    queries = hits.topic_to_queries(topics)
    found = hits.search_and_merge(spark, queries, providers)
    # merged hits are one per DOI: no key can be hot, so no salt is needed
    resolved = resolve.resolve(found, oa_snapshot, pmc_snapshot, salts=1)
    return dedupe.unique_by_url(resolve.keep_resolved(resolved))


def with_fetches(resolved: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """Landing rows for the ingest flow: each location with the body of its best attempt.

    An attempt at the alternate form of a URL is logged under the form that was tried; it counts for
    the location itself, and a success comes before any failure. Attempts at a URL have numbers of their own.
    """
    log = fetch_log.withColumnRenamed("pdf_url", "request_url")
    failed = F.coalesce(F.col("status") != 200, F.lit(True))
    # choose by small columns, one row per form that was tried, and fetch the chosen bodies last
    tried = log.groupBy("request_url").agg(F.min(F.struct(failed.alias("failed"), "attempt")).alias("_try"))
    plan = resolve.fetch_plan(resolved).select("pdf_url", "try_no", "request_url").join(tried, "request_url")
    preference = F.struct("_try.failed", "try_no", "_try.attempt")
    best = plan.groupBy("pdf_url").agg(F.min_by(F.struct("request_url", "_try.attempt"), preference).alias("_best"))
    chosen = best.select("pdf_url", "_best.request_url", "_best.attempt")
    bodies = chosen.join(log.select("request_url", "attempt", "status", "content"), ["request_url", "attempt"])
    joined = resolved.join(hits.numbered(resolved, "pdf_url"), "pdf_url").join(bodies, "pdf_url")
    return joined.select(
        "doi", "title", "year", F.col("resolver_source").alias("source"), "pdf_url", "status", "content",
        F.col("n").alias("ord"),
    )


def run(
    spark: SparkSession,
    topics: DataFrame,
    providers: Sequence[Provider],
    oa_snapshot: DataFrame,
    pmc_snapshot: DataFrame,
    fetch_log: DataFrame,
    flow: IngestFlow,
) -> None:
    """The whole job, into the flow's tables."""
    resolved = find_papers(spark, topics, providers, oa_snapshot, pmc_snapshot)
    flow.store_batch(with_fetches(resolved, fetch_log), 0)
