"""JSON and Parquet sources and sinks of hits, resolved hits and ranked titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators.hits import Provider, coerce_hits
from quillmill.session import written


BROKEN = "_broken"


def read_hits(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Hits from JSON, and rejects ``(stage, key, reason, record)`` of what is no hit.

    The input is an array per file or (``multi_line=False``) an object per line: use lines for large dumps, as Spark splits those
    files, while an array is read by one task. A broken line, an array that ends early or a value of the wrong type
    is a reject with its file and text; of an array that ends early, no hit counts.
    """
    found = _parsed(spark, path, schemas.HIT, multi_line)
    rejects = found.filter(F.col(BROKEN).isNotNull()).select(
        F.lit("read").alias("stage"), F.col("_file").alias("key"), F.lit("broken_json").alias("reason"), F.col(BROKEN).alias("record"))
    return coerce_hits(found.filter(F.col(BROKEN).isNull()).drop(BROKEN, "_file")), rejects


def _parsed(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    """Every record with its file; the text of a record that does not parse is in ``BROKEN``. Parsed once, into the work folder."""
    reader = spark.read.schema(f"{schema}, {BROKEN} string").option("multiLine", multi_line)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    return written(reader.json(path).withColumn("_file", F.col("_metadata.file_path")), "json")


def read_hits_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The hits of ``read_hits`` alone."""
    return read_hits(spark, path, multi_line)[0]


def write_hits_json(hits: DataFrame, path: str, mode: str = "errorifexists") -> None:
    hits.select(*schemas.HIT_COLUMNS).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_resolved_json(resolved: DataFrame, path: str, mode: str = "errorifexists") -> None:
    resolved.select(*schemas.RESOLVED_COLUMNS).write.mode(mode).option("ignoreNullFields", False).json(path)


def read_titles_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``sentence`` rows from the titles of a hit file."""
    return read_hits_json(spark, path, multi_line).select(F.col("title").alias("sentence"))


def write_ranked_json(ranked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Sentence and score, the score as a string."""
    ranked.select("sentence", F.col("score").cast("string").alias("score")).write.mode(mode).json(path)


def json_provider(name: str, path: str, hit_idx: str = "hit_idx") -> Provider:
    """A dump as JSON lines of the hit columns and a running number."""

    def load(spark: SparkSession) -> DataFrame:
        found = _parsed(spark, path, f"{schemas.HIT}, {hit_idx} bigint", False)
        return coerce_hits(found.filter(F.col(BROKEN).isNull()).drop(BROKEN, "_file")).withColumnRenamed(hit_idx, "hit_idx")

    return Provider(name, load)


def parquet_provider(name: str, path: str, hit_idx: str = "hit_idx") -> Provider:
    def load(spark: SparkSession) -> DataFrame:
        return coerce_hits(spark.read.parquet(path)).withColumnRenamed(hit_idx, "hit_idx")

    return Provider(name, load)
