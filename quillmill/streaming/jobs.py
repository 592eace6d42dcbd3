"""Structured Streaming jobs: URL de-duplication, the staged ingest flow and the status fold.

All of them read a landing folder, stop when it is drained (``availableNow``) unless another
trigger is given, and keep their progress in a checkpoint folder. Whatever a batch writes is
keyed, or goes to a folder of that batch, so that a batch that runs again leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillmill import schemas
from quillmill.functions import text as tx
from quillmill.operators import documents, ingest, store, vector_search
from quillmill.operators.dedupe import last_by_key
from quillmill.session import written
from quillmill.sources import files, tables
from quillmill.streaming import fetches

# Fixed value: how much may wait, here as files per micro-batch
MAX_FILES_PER_BATCH = 200

PAPER_TABLES = {
    "papers": tables.Table(schemas.PAPERS, ["doi"], "id"),
    "summaries": tables.Table(schemas.SUMMARIES, ["paper_id", "summary_type"], "id"),
    "embeddings": tables.Table(schemas.EMBEDDINGS, ["paper_id", "embedding_type"], "id"),
    "paper_metadata": tables.Table(schemas.PAPER_METADATA, ["paper_id", "key"], "id"),
}
STAGE_LOG = "stage string, key string, ok boolean, reason string, at timestamp, batch_id bigint"

# What a landing row has to carry for the whole flow
LANDING = "doi string, title string, year int, source string, pdf_url string, status int, content binary, ord bigint"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state on the executors' disks instead of their heaps: for many keys."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", fetches.ROCKSDB_STATE)


def landing_stream(
    spark: SparkSession,
    folder: str,
    schema: str,
    pattern: str | None = None,
    file_format: str = "parquet",
    max_files: int = MAX_FILES_PER_BATCH,
) -> DataFrame:
    """New files of a folder; ``max_files`` per batch is the back-pressure."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def unique_stream(stream: DataFrame, key: str = "pdf_url", event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """First row per key over the whole life of the query, or within ``delay`` of event time.

    Without an event time the state grows with the number of keys; with one it is bounded.
    """
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def append_unique(stream: DataFrame, output: str, checkpoint: str, key: str = "pdf_url", **options) -> StreamingQuery:
    """Write the unique rows of a stream to Parquet."""
    writer = unique_stream(stream, key, **options).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(output)


def parse_text(content: Column) -> Column:
    """Default parser of fetched bytes: UTF-8 text or HTML to clean text; NULL when undecodable."""
    return tx.strip_html(F.try_validate_utf8(content.cast("string")))


def describe_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """Default metadata of texts, ``(key, metadata)``: what the patterns find, and the most frequent words of each text."""
    found = documents.metadata_fields(df, text, key).join(documents.frequent_words(df, text, key), key, "left")
    fields = F.struct("keywords", *documents.METADATA_PATTERNS).cast(documents.METADATA_SCHEMA)
    return found.select(key, fields.alias("metadata"))


@dataclass
class IngestFlow:
    """The staged flow: fetched -> parsed -> described, summarised and embedded -> stored.

    ``parse`` turns bytes into text; ``describe(df, text, key)`` gives ``metadata``; ``summarise(df, text, *keys)`` gives
    ``(*keys, summary_type, content)``; ``embedder`` fills ``embedding``. A document without all kinds of summary, or without any
    embedding, is not stored. Items that fail a stage go to the stage log with a reason and the rest goes on.

    A batch's edits of all tables count together: whatever ends it early, the tables stay as they were before it.
    """

    folder: str
    parse: Callable[[Column], Column] = parse_text
    summarise: Callable[..., DataFrame] = documents.extractive_summaries
    describe: Callable[..., DataFrame] = describe_text
    embedder: Callable[..., DataFrame] = field(default_factory=vector_search.hash_embedder)
    buckets: int = tables.DEFAULT_BUCKETS
    as_of: Column | None = None
    summary_kinds: int = len(documents.PROMPTS)

    @property
    def store(self) -> tables.Store:
        return tables.Store(f"{self.folder}/tables", PAPER_TABLES, self.buckets)

    def create(self, spark: SparkSession) -> None:
        """Make the empty tables."""
        self.store.create(spark)
        log = spark.createDataFrame([], STAGE_LOG)
        log.write.partitionBy("batch_id").parquet(f"{self.folder}/stage_log")

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return self.store.read(spark, name)

    def stage_log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(STAGE_LOG).parquet(f"{self.folder}/stage_log")

    def start(self, landing: DataFrame, checkpoint: str, retries: bool = True) -> StreamingQuery:
        """Start the flow over a stream of ``LANDING`` rows.

        With ``retries`` a URL stays open until an attempt succeeds or its attempts are used up; without, every row is taken.
        """
        stream = fetches.fetch_outcomes(landing) if retries else landing
        writer = stream.writeStream.foreachBatch(self.store_batch).option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(availableNow=True).start()

    def store_batch(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch, or a whole backlog as a batch job, through all stages.

        Each stage's result is written once to the work folder; the steps after it read that. A batch that runs again
        after its tables counted overwrites them with the same values, and its part of the log.
        """
        spark = batch.sparkSession
        now = F.current_timestamp() if self.as_of is None else self.as_of
        edits = self.store.begin(spark)
        parsed = written(self._parsed(batch), "parsed")
        judged = written(self._judged(edits, parsed), "judged")
        unique = judged.filter(F.col("reason").isNull())
        texts = written(parsed.join(unique.select("doi", "ord"), ["doi", "ord"], "left_semi").select("doi", "text", "ord"), "texts")
        summaries, unsummarised = documents.keep_complete(
            written(self.summarise(texts, "text", "doi"), "summaries"), "doi", self.summary_kinds, texts)
        vectors, unembedded = vector_search.embed_sections(documents.sections(texts, "text", "doi"), self.embedder, "doi", among=texts)
        failed = written(unsummarised.unionByName(unembedded), "failed")
        good = unique.join(failed.select(F.col("key").alias("doi")).distinct(), "doi", "left_anti")
        edits.edit(
            "papers", good.select("doi", "title", "year", "pdf_url", "sha256", "source", "ord"),
            lambda old, new: store.upsert_papers(old, new, now, max_id=edits.last_id("papers")),
        )
        known = edits.read("papers").select("doi", F.col("id").alias("paper_id"))
        ids = written(good.select("doi", "ord").join(known, "doi"), "paper-ids")
        described = documents.metadata_rows(self.describe(texts, "text", "doi"), "doi").withColumnRenamed("paper_id", "doi")
        for name, rows, keys, value, touch in (
            ("summaries", summaries, ["paper_id", "summary_type"], "content", True),
            ("embeddings", vectors, ["paper_id", "embedding_type"], "embedding", False),
            ("paper_metadata", described, ["paper_id", "key"], "value", True),
        ):
            edits.edit(
                name, rows.join(ids, "doi").drop("doi"),
                lambda old, new, n=name, k=keys, v=value, t=touch: store.upsert(old, new, k, [v], now, touch=t, max_id=edits.last_id(n)),
            )
        edits.commit()
        self._log(parsed, judged, failed, now, batch_id)

    def _parsed(self, batch: DataFrame) -> DataFrame:
        """Every fetched row with its hash and text, or with the reason why there is none."""
        accepted = F.col("status") == 200
        text = F.when(accepted, self.parse(F.col("content")))
        rows = batch.withColumn("sha256", F.when(accepted, tx.sha256_hex(F.col("content")))).withColumn("text", text)
        empty = F.col("text").isNull() | tx.is_blank(F.col("text"))
        refused = ingest.http_reason(F.col("status"))
        if "outcome" in batch.columns:
            refused = F.when(F.col("outcome") == fetches.REJECTED, F.concat(refused, F.lit(", given up"))).otherwise(refused)
        reason = F.when(~F.coalesce(accepted, F.lit(False)), refused).when(empty, "empty_text")
        return rows.withColumn("reason", reason).drop("content")

    def _judged(self, edits: tables.Batch, parsed: DataFrame) -> DataFrame:
        """Parsed rows without their texts, one per DOI, with a reason for those not to be stored.

        The last row of a DOI counts, and the first DOI of each file; DOIs stored before go first.
        """
        narrow = parsed.filter(F.col("reason").isNull()).select("doi", "title", "year", "source", "pdf_url", "ord", "sha256")
        latest = last_by_key(narrow, ["doi"], ["ord"])
        first = latest.groupBy("sha256").agg(F.min_by("doi", "ord").alias("_first"))
        stored = edits.read("papers").select("sha256", F.col("doi").alias("_stored"))
        owners = first.join(stored, "sha256", "left").select(
            "sha256", F.coalesce("_stored", "_first").alias("doi"), F.lit(True).alias("_owns")
        )
        # with the DOI in the key no key is hot, however many copies a file has
        marked = latest.join(owners, ["sha256", "doi"], "left")
        return marked.withColumn("reason", F.when(F.col("_owns").isNull(), "duplicate_sha256")).drop("_owns")

    def _log(self, parsed: DataFrame, judged: DataFrame, failed: DataFrame, now: Column, batch_id: int) -> None:
        """What became of every item at every stage; a document that failed a stage goes no further."""

        def stage(name: str, rows: DataFrame, reason: Column) -> DataFrame:
            return rows.select(F.lit(name).alias("stage"), F.col("pdf_url").alias("key"), reason.alias("reason"))

        fetched = F.col("sha256").isNotNull()
        log = stage("download", parsed, F.when(~fetched, F.col("reason")))
        log = log.unionByName(stage("parse", parsed.filter(fetched), F.col("reason")))
        for name in ("summarise", "embed"):
            lost = failed.filter(F.col("stage") == name).select(F.col("key").alias("doi"), F.col("reason").alias("_failed"))
            of_stage = judged.filter(F.col("reason").isNull()).join(lost, "doi", "left")
            log = log.unionByName(stage(name, of_stage, F.col("_failed")))
        lost = failed.select(F.col("key").alias("doi")).distinct()
        log = log.unionByName(stage("store", judged.join(lost, "doi", "left_anti"), F.col("reason")))
        log = log.withColumn("ok", F.col("reason").isNull()).withColumn("at", now)
        writer = log.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.folder}/stage_log")


def store_files(landing: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """The two-stage variant: accepted bodies into the content-addressed file table, nothing further.

    One row per content: the first of every hash, over the whole life of the query.
    """
    accepted = files.stored_files(ingest.accepted_fetches(landing).select("pdf_url", "content"))
    return append_unique(accepted, output, checkpoint, key="sha256")


STATUS_STATE = "ingest_id bigint, status string, last_error string, errors bigint"


def status_stream(events: DataFrame, output: str, checkpoint: str, buckets: int = 8) -> StreamingQuery:
    """Fold a stream of status events; the latest state of every item is kept in a keyed table.

    The running aggregate holds the whole state of an item, so a batch that runs again
    overwrites with the same values and counts nothing twice.
    """
    spark = events.sparkSession
    tables.create_table(spark.createDataFrame([], STATUS_STATE), output, ["ingest_id"], buckets)

    def store_changes(changed: DataFrame, batch_id: int) -> None:
        tables.edit_table(
            changed.sparkSession, output, STATUS_STATE, ["ingest_id"], changed,
            lambda old, new: old.join(new.select("ingest_id"), "ingest_id", "left_anti").unionByName(new), buckets,
        )

    folded = ingest.fold_status_events(events)
    writer = folded.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(store_changes).trigger(availableNow=True).start()
