"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.session import written


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for the nodes of ``edges`` (a, b).

    Alternating large and small stars: each round every node hangs its larger neighbours, then its
    smaller ones, on the least of them, until all are stars; the number of rounds grows with the
    logarithm of the longest path. No neighbourhood is gathered: only least neighbours are aggregated.
    """
    links = written(_ordered(edges.select("a", "b")), purpose)
    while not _settled(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.least("b", "m").alias("a"), F.greatest("b", "m").alias("b"))
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select("m", "a", "b")
        hung = small.select(F.col("m").alias("a"), F.col("b")).unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        links = written(_ordered(hung), purpose)
    roots = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    tops = links.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    return roots.unionByName(tops)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the lesser end in ``a``; loops go."""
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and nothing hangs on a node that hangs."""
    seen = links.select(F.col("b").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    seen = seen.unionByName(links.select(F.col("a").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    odd = seen.groupBy("node").agg(F.sum("hangs").alias("n"), F.max("holds").alias("held")).filter("n > 1 or n = 1 and held = 1")
    return odd.isEmpty()
