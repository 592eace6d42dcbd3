"""Topics, queries and search hits."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.functions import text as tx
from quillmill.operators.dedupe import merge_hits
from quillmill.operators.running import laid_in_order

log = logging.getLogger(__name__)

# Fixed values
HIT_DEFAULTS = {"title": "", "doi": "", "url": "", "year": 0, "source": "unknown", "score": 0.0}


@dataclass(frozen=True)
class Provider:
    """A metadata source: a name and a function that gives its dump.

    The dump has the hit columns and ``hit_idx``, the provider's own order.
    """

    name: str
    load: Callable[[SparkSession], DataFrame]


def topic_to_queries(
    topics: DataFrame,
    variants: Callable[[Column], Sequence[Column]] = lambda topic: [topic],
    max_variants: int | None = None,
) -> DataFrame:
    """``topic`` rows to ``(query_idx, topic, query)``: distinct variants, in order; all of them, or the
    first ``max_variants`` if the caller sets a number."""
    wanted = F.array_distinct(F.array_compact(F.array(*variants(F.col("topic")))))
    wanted = wanted if max_variants is None else F.slice(wanted, 1, max_variants)
    return topics.select("topic", F.posexplode(wanted)).select(
        F.col("pos").alias("query_idx"), "topic", F.col("col").alias("query")
    )


def coerce_hits(df: DataFrame) -> DataFrame:
    """Hit columns with their types; a missing or NULL value gets its default."""
    types = dict(part.split(" ") for part in schemas.HIT.split(", "))
    extra = [c for c in df.columns if c not in schemas.HIT_COLUMNS]
    columns = []
    for name in schemas.HIT_COLUMNS:
        default = F.lit(HIT_DEFAULTS[name]).cast(types[name])
        present = name in df.columns
        columns.append((F.coalesce(F.col(name).cast(types[name]), default) if present else default).alias(name))
    return df.select(*columns, *extra)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, with ``source_idx`` saying which frame a row came from."""
    tagged = [df.withColumn("source_idx", F.lit(i)) for i, df in enumerate(frames)]
    united = tagged[0]
    for df in tagged[1:]:
        united = united.unionByName(df)
    return united


def provider_rows(spark: SparkSession, providers: Sequence[Provider]) -> DataFrame:
    """The dumps of all providers; one that cannot be read is logged and gives no rows."""
    empty = spark.createDataFrame([], schemas.HIT + ", hit_idx bigint")
    frames = []
    for provider in providers:
        try:
            frames.append(provider.load(spark).select(*schemas.HIT_COLUMNS, "hit_idx"))
        except (PySparkException, OSError) as error:
            log.warning("provider %s failed: %s", provider.name, error)
            frames.append(empty)
    return union_sources(frames or [empty])


def search(spark: SparkSession, queries: DataFrame, providers: Sequence[Provider]) -> DataFrame:
    """All hits of all queries at all providers, with ``ord``; a hit matches when its title has
    every word of the query.

    An inverted-index join: title words meet query words, and matches are counted per
    (query, hit). Spark broadcasts the query words when they are small enough and
    splits frequent words otherwise.
    """
    dump = provider_rows(spark, providers)
    # number and text together tell queries apart, as every topic numbers its own
    asked = queries.select("query_idx", "query").distinct().withColumn("words", F.array_distinct(tx.words(F.col("query"))))
    query_words = asked.select("query_idx", "query", F.size("words").alias("wanted"), F.explode("words").alias("word"))
    title_words = dump.withColumn("word", F.explode(F.array_distinct(tx.words(F.col("title")))))
    identity = ["query_idx", "query", "source_idx", "hit_idx", *schemas.HIT_COLUMNS, "wanted"]
    matched = title_words.join(query_words, "word").groupBy(*identity).agg(F.count(F.lit(1)).alias("found"))
    return matched.filter(F.col("found") == F.col("wanted")).select(
        *schemas.HIT_COLUMNS, F.struct("query_idx", "source_idx", "hit_idx").alias("ord")
    )


def numbered(found: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """``(key, n)``: a number that sorts as the order struct does, for rows that ``key`` tells apart, however many queries there are.

    Only key and order are laid in order, by ranges.
    """
    return laid_in_order(found.select(key, order), [order, key], "n", "numbered").select(key, "n")


def search_and_merge(spark: SparkSession, queries: DataFrame, providers: Sequence[Provider]) -> DataFrame:
    """Search, then one hit per DOI: the first by query, provider and provider order."""
    return merge_hits(search(spark, queries, providers))
