"""Keyed de-duplication: which row wins is always said by an order, never by arrival at a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.session import written


def _one_by_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``. Every task sends on at most one row per key."""
    return _one_by_key(df, keys, order, F.min_by)


def last_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    return _one_by_key(df, keys, order, F.max_by)


def merge_hits(hits: DataFrame, order: str = "ord") -> DataFrame:
    """First hit per DOI, exact case; hits without a DOI are left out.

    The ``order`` column stays, so that a sink or report can sort by it.
    """
    with_doi = hits.filter(F.col("doi").isNotNull() & (F.col("doi") != ""))
    return first_by_key(with_doi, ["doi"], [order])


def unique_by_url(resolved: DataFrame, order: str = "ord") -> DataFrame:
    """First row per ``pdf_url``."""
    return first_by_key(resolved, ["pdf_url"], [order])


def drop_processed(items: DataFrame, processed: DataFrame, key: str = "pdf_url") -> DataFrame:
    """Items whose key is not in the table of processed ones."""
    return items.join(processed.select(key).distinct(), key, "left_anti").select(*items.columns)


def split_by_content(df: DataFrame, content: Column, row_id: str) -> tuple[DataFrame, DataFrame]:
    """Kept rows and rejects by SHA-256 of ``content``: the lowest ``row_id`` of each hash is kept.

    Only hash and id are shuffled. The rows that lose are looked up by ``row_id``, which is unique, and are as many
    as there are copies; while these ids can be broadcast no payload leaves its task. NULL content equals nothing and is kept,
    and so is a row without an id.
    """
    hashed = df.withColumn("sha256", tx.sha256_hex(content))
    marks = hashed.filter(F.col("sha256").isNotNull()).select("sha256", row_id)
    # one row a hash from every task
    groups = marks.groupBy("sha256").agg(F.min(row_id).alias("_first"), F.max(row_id).alias("_last"))
    copied = groups.filter(F.col("_first") != F.col("_last")).select("sha256", "_first")
    # read back from a table, so that Spark may split the ids of a hash that very many rows have
    copied = written(copied, "copied")
    losers = written(marks.join(copied, "sha256").filter(F.col(row_id) != F.col("_first")).select(row_id), "copies")
    kept = hashed.join(losers, row_id, "left_anti")
    rejects = hashed.join(losers, row_id, "left_semi").withColumn("reason", F.lit("duplicate_sha256"))
    return kept.select(*hashed.columns), rejects.select(*hashed.columns, "reason")


def title_key(title: Column) -> Column:
    """The words of a title, lower-cased and sorted: equal for titles that differ only in
    case, marks, blanks or word order. NULL when there is no word."""
    words = F.array_sort(tx.words(title))
    return F.when(F.size(words) > 0, F.array_join(words, " "))


def merge_by_title(hits: DataFrame, order: str = "ord") -> DataFrame:
    """First hit per ``title_key``; hits whose title has no word are kept as they are.

    Linear in the hits: no pairs of titles are compared.
    """
    keyed = hits.withColumn("_title_key", title_key(F.col("title")))
    titled = keyed.filter(F.col("_title_key").isNotNull())
    untitled = keyed.filter(F.col("_title_key").isNull())
    return first_by_key(titled, ["_title_key"], [order]).unionByName(untitled).drop("_title_key")
