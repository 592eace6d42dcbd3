"""Edges between papers, and the key-value metadata of papers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_where(edges: DataFrame, relationship_type: str | None = None, min_confidence: float | None = None) -> DataFrame:
    """Edges of a type and at least a confidence; an edge without one does not pass a bound."""
    if relationship_type is not None:
        edges = edges.filter(F.col("relationship_type") == relationship_type)
    if min_confidence is not None:
        edges = edges.filter(F.col("confidence") >= min_confidence)
    return edges


def _neighbours(edges: DataFrame, papers: DataFrame, start: str, end: str, paper_id: int | None) -> DataFrame:
    if paper_id is not None:
        edges = edges.filter(F.col(start) == paper_id)
    ends = papers.select(F.col("id").alias(end), F.col("title").alias("neighbour_title"))
    joined = edges.select(start, end, "relationship_type", "confidence").join(ends, end)
    return joined.select(
        F.col(start).alias("paper_id"), F.col(end).alias("neighbour_id"), "neighbour_title", "relationship_type", "confidence"
    )


def out_neighbours(edges: DataFrame, papers: DataFrame, paper_id: int | None = None) -> DataFrame:
    """Papers that ``paper_id`` points at; of every paper when it is None."""
    return _neighbours(edges, papers, "source_paper_id", "target_paper_id", paper_id)


def in_neighbours(edges: DataFrame, papers: DataFrame, paper_id: int | None = None) -> DataFrame:
    """Papers that point at ``paper_id``; of every paper when it is None."""
    return _neighbours(edges, papers, "target_paper_id", "source_paper_id", paper_id)


def metadata_of(metadata: DataFrame, paper_id: int, key: str | None = None) -> DataFrame:
    found = metadata.filter(F.col("paper_id") == paper_id)
    return found if key is None else found.filter(F.col("key") == key)


def metadata_values(metadata: DataFrame, path: str = "$", as_type: str = "string") -> DataFrame:
    """Add ``typed``: the JSON value at ``path`` read as ``as_type``; NULL when it is none or broken."""
    parsed = F.try_parse_json("value")
    return metadata.withColumn("typed", F.try_variant_get(parsed, path, as_type))


def metadata_pivot(metadata: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per paper with a column for each key (one value per paper and key)."""
    return metadata.groupBy("paper_id").agg(
        *[F.max(F.when(F.col("key") == key, F.col("value"))).alias(key) for key in keys]
    )
