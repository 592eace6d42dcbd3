"""Vector column builders and their SQL names."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Similarities are rounded here so that equal vectors tie, whatever the order of summing was
SIMILARITY_DIGITS = 9


def vector_literal(values: Sequence[float]) -> Column:
    """One array literal, also for thousands of dimensions."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def parse_vector(text: Column) -> Column:
    """``"[0.1, 0.2]"`` to an array of floats; NULL when it is no such list."""
    return F.from_json(text, "array<float>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine_similarity(a: Column, b: Column) -> Column:
    """NULL for a NULL or all-zero vector, or when the sizes differ."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def similarity_to(query: Sequence[float]):
    """A function of a vector column: cosine similarity to one fixed query vector.

    Works on whole Arrow batches with numpy, which at hundreds of dimensions is far faster
    than lambdas over arrays. NULL for a NULL, all-zero or wrongly sized vector.
    """
    target = np.asarray(query, dtype="float64")
    length = float(np.linalg.norm(target))
    target = target / length if length > 0 else np.full_like(target, np.nan)

    @F.arrow_udf("double")
    def similarity(vectors: pa.Array) -> pa.Array:
        sizes = np.asarray(vectors.value_lengths().fill_null(-1))
        usable = sizes == len(target)
        scores = np.full(len(vectors), np.nan)
        if usable.any():
            flat = vectors.filter(pa.array(usable)).flatten()
            block = flat.to_numpy(zero_copy_only=False).astype("float64").reshape(-1, len(target))
            lengths = np.linalg.norm(block, axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                scores[usable] = np.round(block @ target / lengths, SIMILARITY_DIGITS)
        return pa.array(scores, mask=~np.isfinite(scores))

    # else a filter on the result is pushed below the projection, and every vector scored twice
    return similarity.asNondeterministic()


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def unit(a: Column) -> Column:
    """The vector at length one (as floats); NULL for an all-zero vector."""
    length = norm(a)
    scaled = F.transform(a, lambda x: (x.cast("double") / length).cast("float"))
    return F.when(length > 0, scaled)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``cosine_similarity`` and ``cosine_distance`` callable from SQL."""
    total = "aggregate(zip_with({0}, {1}, (x, y) -> x * y), 0D, (t, p) -> t + p)"
    similarity = "try_divide({ab}, sqrt({aa}) * sqrt({bb}))".format(
        ab=total.format("a", "b"), aa=total.format("a", "a"), bb=total.format("b", "b")
    )
    for name, body in (("cosine_similarity", similarity), ("cosine_distance", f"1D - {similarity}")):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) "
            f"RETURNS DOUBLE RETURN {body}"
        )


def register_find_similar_papers(spark: SparkSession, embeddings_view: str, papers_view: str) -> None:
    """SQL table function ``find_similar_papers(query_embedding, similarity_threshold)``.

    The caller adds ``ORDER BY similarity DESC LIMIT n``, which Spark runs as a top-n per task.
    """
    register_sql_functions(spark)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION find_similar_papers(
            query_embedding ARRAY<DOUBLE>, similarity_threshold DOUBLE DEFAULT 0.7)
        RETURNS TABLE (paper_id BIGINT, title STRING, similarity DOUBLE)
        RETURN
            WITH near AS (
                SELECT paper_id, cosine_similarity(embedding, query_embedding) AS similarity FROM {embeddings_view})
            SELECT paper_id, title, similarity
            FROM near JOIN (SELECT id AS paper_id, title FROM {papers_view}) USING (paper_id)
            WHERE similarity > similarity_threshold
        """
    )
