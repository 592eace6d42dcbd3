"""Files by the hash of their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text as tx


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, content)`` of all files in a folder; Spark passes over files without a byte."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.load(path).select("path", "content")


def stored_files(contents: DataFrame, content: str = "content") -> DataFrame:
    """Add ``sha256``, ``file_path`` (``<hash>.pdf``) and ``size`` to rows with bytes."""
    hashed = contents.withColumn("sha256", tx.sha256_hex(F.col(content)))
    return hashed.withColumn("file_path", F.concat("sha256", F.lit(".pdf"))).withColumn(
        "size", F.length(content).cast("bigint")
    )


def unique_files(stored: DataFrame) -> DataFrame:
    """``(sha256, file_path, size, copies)``: one row per content."""
    return stored.groupBy("sha256", "file_path", "size").agg(F.count(F.lit(1)).alias("copies"))


def write_files(stored: DataFrame, path: str, content: str = "content") -> None:
    """The content-addressed table: one row of bytes per hash, spread by hash prefix over folders."""
    one_each = stored.groupBy("sha256", "file_path", "size").agg(F.any_value(content).alias("content"))
    one_each.withColumn("prefix", F.substring("sha256", 1, 2)).write.mode("append").partitionBy("prefix").parquet(path)
