"""The given tables seen as hits, papers, snapshots, queues and so on.

Nothing is filtered away to make work smaller: every view covers its whole table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators import dedupe
from quillmill.operators.hits import Provider
from quillmill.session import written
from quillmill.sources.tables import dealt_out, driver_table, spread_table

CREATED = "2024-01-01 00:00:00"
AS_OF = "2024-06-01 00:00:00"

PAPER_COLUMNS = [
    "id", "doi", "title", "authors", "year", "pdf_url", "file_path", "sha256", "source", "created_at", "updated_at"
]


def stamp(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def title() -> Column:
    """The first sentence of the text."""
    return F.regexp_extract("text", r"^[^.!?\n]*", 0)


def doi() -> Column:
    """A DOI from the text's hash, so that copies of a text are the same paper. Its first digit says
    which publisher's form it has, or that it is missing."""
    h = F.col("h")
    forms = {
        "0": F.concat(F.lit("10.48550/arXiv."), h),
        "1": F.concat(F.lit("10.1145/"), h),
        "2": F.concat(F.lit("10.20944/preprints"), h),
        "3": F.concat(F.lit("10.31219/OSF.io/"), h, F.lit("_v1")),
        "4": F.concat(F.lit("10.22541/au."), h),
        "5": F.lit(""),
        "6": F.lit(None).cast("string"),
    }
    value = F.concat(F.lit("10.1000/"), F.upper(h))
    for digit, form in forms.items():
        value = F.when(h.startswith(digit), form).otherwise(value)
    return value


def url() -> Column:
    no = F.col("doc_id").cast("string")
    return (
        F.when(F.col("lang") == "de", F.concat(F.lit("https://files.example.org/"), F.col("h"), F.lit(".pdf")))
        .when((F.col("lang") == "es"), F.concat(F.lit("https://www.preprints.org/manuscript/"), no, F.lit("/v1//")))
        .otherwise(F.concat(F.lit("https://doi.org/"), F.col("h")))
    )


@dataclass(frozen=True)
class Inputs:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return driver_table(self.spark, self.folder, name)

    @property
    def documents(self) -> DataFrame:
        return spread_table(self.spark, self.folder, "documents")

    @property
    def pages(self) -> DataFrame:
        return spread_table(self.spark, self.folder, "pages")

    @cached_property
    def hits(self) -> DataFrame:
        """Every document as a search hit, in ``doc_id`` order; keeps ``doc_id`` and ``lang``.

        Written once per query: plans that use hits several times then read the texts once.
        """
        hashed = self.documents.withColumn("h", F.substring(F.sha2("text", 256), 1, 12))
        return written(hashed.select(
            title().alias("title"), doi().alias("doi"), url().alias("url"),
            (F.lit(2000) + F.col("n_chars") % 25).cast("int").alias("year"), "source",
            ((F.col("n_chars") % 100) / 100.0).alias("score"),
            F.col("doc_id").alias("ord"), "doc_id", "lang", "h", F.sha2("text", 256).alias("sha256"),
        ), "hits")

    @property
    def oa_snapshot(self) -> DataFrame:
        """A record per hit with a DOI; Spanish ones have an empty URL and French ones no location."""
        pdf = F.concat(F.lit("https://oa.example.org/"), F.col("h"), F.lit(".pdf"))
        location = F.struct(F.when(F.col("lang") == "es", F.lit("")).otherwise(pdf).alias("url_for_pdf"))
        return self.hits.filter(F.col("doi") != "").select(
            F.lower("doi").alias("doi"), F.when(F.col("lang") != "fr", location).alias("best_oa_location")
        )

    @property
    def pmc_snapshot(self) -> DataFrame:
        """A record per labelled hit with a DOI; those labelled toxic have no id."""
        labelled = self.hits.filter(F.col("doi") != "").join(self.table("labels"), "doc_id")
        pmcid = F.concat(F.lit("PMC"), F.col("doc_id").cast("string"))
        return labelled.select("doi", F.col("doc_id").alias("rank"), F.when(F.col("toxic") == 0, pmcid).alias("pmcid"))

    @property
    def incoming_papers(self) -> DataFrame:
        """Every document with a non-empty DOI or none, as a row to store; copies share a DOI."""
        found = self.hits.filter(F.col("doi").isNull() | (F.col("doi") != ""))
        return found.select("doi", "title", "year", F.col("url").alias("pdf_url"), "sha256", "source", "ord")

    @cached_property
    def papers(self) -> DataFrame:
        """The labelled documents as a stored table of papers, one per DOI."""
        labelled = self.hits.filter(F.col("doi") != "").join(self.table("labels").select("doc_id"), "doc_id", "left_semi")
        first = dedupe.merge_hits(labelled)
        return written(first.select(
            F.col("doc_id").alias("id"), "doi", F.concat(F.lit("old "), F.col("title")).alias("title"),
            F.array(F.col("lang")).alias("authors"), F.lit(1999).alias("year"), F.col("url").alias("pdf_url"),
            F.lit(None).cast("string").alias("file_path"), F.col("h").alias("sha256"), "source",
            stamp(CREATED).alias("created_at"), stamp(CREATED).alias("updated_at"),
        ), "papers")

    @property
    def titled(self) -> DataFrame:
        """Every document as ``(id, title)``."""
        return self.documents.select(F.col("doc_id").alias("id"), title().alias("title"))

    @property
    def vectors(self) -> DataFrame:
        """The vectors as paper embeddings; the label tells the type."""
        kind = F.element_at(F.array(*map(F.lit, ["title", "abstract", "full_text"])), F.col("label") % 3 + 1)
        return self.table("embeddings").select(
            F.col("vec_id").alias("paper_id"), kind.alias("embedding_type"), "embedding", "label"
        )

    def vector(self, vec_id: int) -> list[float]:
        """One stored vector, to search with."""
        return list(self.table("embeddings").filter(F.col("vec_id") == vec_id).first()["embedding"])

    @property
    def label_centres(self) -> DataFrame:
        """``(query_id, embedding)``: the mean vector of every label."""
        parts = self.table("embeddings").select("label", F.posexplode("embedding"))
        means = parts.groupBy("label", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
        rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("parts"))
        return rows.select(F.col("label").cast("bigint").alias("query_id"), F.col("parts.mean").alias("embedding"))

    @property
    def fetch_log(self) -> DataFrame:
        """Every event as an attempt at the page that has the user's number."""
        pages = self.table("pages").select(F.col("page_id").alias("user_id"), F.col("url").alias("pdf_url"), "html")
        status = F.when(F.col("event_type") == "error", 404).when(F.col("event_type") == "signup", 403).otherwise(200)
        return self.table("events").join(pages, "user_id").select(
            "pdf_url", F.col("event_id").cast("int").alias("attempt"), status.alias("status"),
            F.col("html").cast("binary").alias("content"), F.col("ts").alias("at"),
        )

    @property
    def status_events(self) -> DataFrame:
        """Every event as a status report on the user's ingest item; error events carry a text."""
        return self.table("events").select(
            F.col("user_id").alias("ingest_id"), F.col("event_id").alias("ord"), F.col("event_type").alias("status"),
            F.when(F.col("event_type") == "error", F.concat(F.lit("code "), F.get_json_object("props", "$.k")))
            .when(F.col("event_type") == "view", F.lit("")).alias("error"),
        )

    @property
    def queue(self) -> DataFrame:
        """Every customer as an ingest item."""
        return self.table("customer").select(
            F.col("c_custkey").alias("ingest_id"), F.col("c_name").alias("file_id"),
            F.when(F.col("c_mktsegment") == "BUILDING", "pending").otherwise("done").alias("status"),
            F.lit(0).alias("retries"), F.lit(None).cast("string").alias("last_error"), stamp(CREATED).alias("updated_at"),
        )

    # customers stand for works, orders for their files, line items for the files' chunks
    @property
    def works(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("work_id"), F.col("c_name").alias("title"))

    @property
    def files(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("file_id"), F.col("o_custkey").alias("work_id"), F.col("o_orderpriority").alias("uri")
        )

    @property
    def chunks(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("file_id"), F.col("l_linenumber").alias("page_from"), F.col("l_partkey").alias("part")
        )

    @property
    def file_summaries(self) -> DataFrame:
        return self.table("orders").filter(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").alias("file_id"), F.lit("tl_dr").alias("kind"), F.col("o_orderpriority").alias("summary_text")
        )

    @property
    def file_jobs(self) -> DataFrame:
        return self.table("lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("file_id"), F.col("l_suppkey").alias("ingest_id")
        )

    @property
    def edges(self) -> DataFrame:
        """Line items as edges between parts and suppliers' numbers, one per pair: the largest first."""
        kind = F.when(F.col("l_returnflag") == "A", "cites").when(F.col("l_returnflag") == "R", "cited_by")
        lines = self.table("lineitem")
        raw = lines.select(
            F.col("l_partkey").alias("source_paper_id"), F.col("l_suppkey").alias("target_paper_id"),
            kind.otherwise("related_to").alias("relationship_type"), F.col("l_discount").alias("confidence"),
        )
        keys = ["source_paper_id", "target_paper_id", "relationship_type"]
        return dealt_out(raw, lines.count(), *keys).groupBy(*keys).agg(F.max("confidence").alias("confidence"))

    @property
    def part_papers(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))

    @property
    def supplier_papers(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))

    @property
    def event_metadata(self) -> DataFrame:
        """The last properties of every user and event type as JSON metadata."""
        rows = self.table("events").select(
            F.col("user_id").alias("paper_id"), F.col("event_type").alias("key"), F.col("props").alias("value"), "event_id"
        )
        return dedupe.last_by_key(rows, ["paper_id", "key"], ["event_id"]).select("paper_id", "key", "value")

    @property
    def topics(self) -> DataFrame:
        """The opening two words of every benchmark passage."""
        return self.table("benchmark").select(
            F.regexp_extract("text", r"^[^\p{L}]*([\p{L}]+[^\p{L}]+[\p{L}]+)", 1).alias("topic"), "item_id"
        )

    @property
    def providers(self) -> list[Provider]:
        """Two dumps: the English hits, and those of all other languages."""

        def dump(english: bool):
            wanted = (F.col("lang") == "en") if english else (F.col("lang") != "en")
            return lambda spark: self.hits.filter(wanted).withColumn("hit_idx", F.col("ord"))

        return [Provider("english", dump(True)), Provider("other", dump(False))]
