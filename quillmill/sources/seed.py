"""Sample rows for the five paper tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill import schemas

EMBEDDING_TYPES = ["title", "abstract", "full_text"]
SAMPLE_KINDS = ["executive", "key_findings", "methodology"]


def _shape(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema).unionByName(df)


def _kinds(names: list[str], alias: str) -> Column:
    return F.posexplode(F.array(*map(F.lit, names))).alias("k", alias)


def sample_tables(spark: SparkSession, n: int, as_of: Column, dim: int = schemas.PAPER_VECTOR_DIM, seed: int = 42) -> dict[str, DataFrame]:
    """``n`` papers with three summaries, three random vectors and three metadata values each, and
    an edge from every paper to the next."""
    ids = spark.range(1, n + 1)
    stamps = {"created_at": as_of, "updated_at": as_of}
    no = F.col("id").cast("string")
    papers = ids.select(
        "id",
        F.concat(F.lit("10.5555/sample-"), no).alias("doi"),
        F.concat(F.lit("Sample paper "), no).alias("title"),
        F.array(F.concat(F.lit("Author "), no)).alias("authors"),
        (F.lit(2000) + F.col("id") % 25).cast("int").alias("year"),
        F.format_string("https://files.example.org/sample-%d.pdf", "id").alias("pdf_url"),
        F.lit(None).cast("string").alias("file_path"),
        F.sha2(no, 256).alias("sha256"),
        F.lit("sample").alias("source"),
    ).withColumns(stamps)
    summaries = ids.select(F.col("id").alias("paper_id"), _kinds(SAMPLE_KINDS, "summary_type")).select(
        ((F.col("paper_id") - 1) * 3 + F.col("k") + 1).alias("id"), "paper_id", "summary_type",
        F.concat(F.lit("Sample text of paper "), F.col("paper_id").cast("string")).alias("content"),
    ).withColumns(stamps)
    # a value per (row, position), from a hash: the same on every run and on every task
    vector = F.transform(
        F.sequence(F.lit(1), F.lit(dim)),
        lambda i: (F.pmod(F.xxhash64(F.lit(seed), "paper_id", "embedding_type", i), F.lit(1_000_000)) / 1_000_000).cast("float"),
    )
    embeddings = ids.select(F.col("id").alias("paper_id"), _kinds(EMBEDDING_TYPES, "embedding_type")).select(
        ((F.col("paper_id") - 1) * 3 + F.col("k") + 1).alias("id"), "paper_id", "embedding_type",
        vector.alias("embedding"), as_of.alias("created_at"),
    )
    values = F.array(
        F.struct(F.lit("keywords").alias("key"), F.lit('["alpha","beta"]').alias("value")),
        F.struct(F.lit("abstract").alias("key"), F.lit('"A sample abstract"').alias("value")),
        F.struct(F.lit("citations").alias("key"), (F.col("id") % 100).cast("string").alias("value")),
    )
    metadata = ids.select("id", F.posexplode(values)).select(
        ((F.col("id") - 1) * 3 + F.col("pos") + 1).alias("id"), F.col("id").alias("paper_id"),
        "col.key", "col.value",
    ).withColumns(stamps)
    edges = ids.filter(F.col("id") < n).select(
        "id", F.col("id").alias("source_paper_id"), (F.col("id") + 1).alias("target_paper_id"),
        F.lit("cites").alias("relationship_type"), F.lit(0.95).alias("confidence"), as_of.alias("created_at"),
    )
    return {
        "papers": _shape(papers, schemas.PAPERS),
        "summaries": _shape(summaries, schemas.SUMMARIES),
        "embeddings": _shape(embeddings, schemas.EMBEDDINGS),
        "paper_metadata": _shape(metadata, schemas.PAPER_METADATA),
        "paper_relationships": _shape(edges, schemas.PAPER_RELATIONSHIPS),
    }
