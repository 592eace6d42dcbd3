"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.functions import text as tx
from quillmill.functions import vectors as vec
from quillmill.operators import (
    cells, constraints, dedupe, documents, fuzzy, graph, hits, ingest, lookups, ranking, resolve, stats, store, vector_search,
)
from quillmill.operators.running import assign_ids
from quillmill.plans import literature
from quillmill.plans.inputs import AS_OF, CREATED, Inputs, stamp
from quillmill.session import work_dir, written
from quillmill.sources import files, tables
from quillmill.sources import hits as hit_files
from quillmill.streaming import fetches, jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RANK_QUERY = "the answer of ention and hand the"


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


def _longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# -- sources and sinks ------------------------------------------------------------------------------


@query
def hit_json_roundtrip(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "hits")
    hit_files.write_hits_json(i.hits, path)
    return _longs(hit_files.read_hits_json(i.spark, path, multi_line=False), "year")


@query
def hit_json_arrays(i: Inputs) -> DataFrame:
    """The hits as files of one JSON array each, a thousand documents a file."""
    path = work_dir(i.spark, "arrays")
    hit = F.struct(*schemas.HIT_COLUMNS)
    blocks = i.hits.groupBy(F.floor(F.col("doc_id") / 1000).alias("block")).agg(F.to_json(F.collect_list(hit)).alias("value"))
    blocks.write.partitionBy("block").text(path)
    return _longs(hit_files.read_hits_json(i.spark, path), "year").drop("block")


@query
def hit_json_rejects(i: Inputs) -> DataFrame:
    """The hits as JSON lines, those of one language cut short: what is read, and what is told as broken."""
    path = work_dir(i.spark, "broken")
    line = F.to_json(F.struct(*schemas.HIT_COLUMNS))
    cut = F.when(F.col("lang") == "de", line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)
    i.hits.select(cut.alias("value")).write.text(path)
    read, rejects = hit_files.read_hits(i.spark, path, multi_line=False)
    of_reads = read.select(F.lit("read").alias("outcome"), "source")
    return of_reads.unionByName(rejects.select(F.col("reason").alias("outcome"), F.col("stage").alias("source"))).groupBy(
        "outcome", "source").agg(F.count("*").alias("n"))


@query
def resolved_json_roundtrip(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "resolved")
    resolved = resolve.keep_resolved(resolve.resolve(i.hits, i.oa_snapshot, i.pmc_snapshot))
    hit_files.write_resolved_json(resolved, path)
    return _longs(i.spark.read.schema(schemas.HIT + ", pdf_url string, resolver_source string").json(path), "year")


@query
def ranked_titles_json(i: Inputs) -> DataFrame:
    titles, ranked = work_dir(i.spark, "titles"), work_dir(i.spark, "ranked")
    hit_files.write_hits_json(i.hits, titles)
    # the order among equal titles does not show in the sink, so any order column will do
    sentences = hit_files.read_titles_json(i.spark, titles, multi_line=False)
    hit_files.write_ranked_json(ranking.rank_sentences(sentences, RANK_QUERY, order="sentence"), ranked)
    read = i.spark.read.schema("sentence string, score string").json(ranked)
    return read.withColumn("score", F.round(F.col("score").cast("double"), 6))


@query
def stored_files(i: Inputs) -> DataFrame:
    stored = files.stored_files(i.documents.select(F.col("text").cast("binary").alias("content")))
    return files.unique_files(stored)


@query
def accepted_fetches(i: Inputs) -> DataFrame:
    return _longs(ingest.accepted_fetches(i.fetch_log), "attempt").select("pdf_url", "attempt", "sha256", "size")


@query
def rejected_fetches(i: Inputs) -> DataFrame:
    return ingest.rejected_fetches(i.fetch_log)


@query
def paper_ids(i: Inputs) -> DataFrame:
    return i.papers.select("id").orderBy("id")


# -- topics, search, resolution -----------------------------------------------------------------------


@query
def topic_queries(i: Inputs) -> DataFrame:
    variants = lambda topic: [topic, F.lower(topic), F.concat(topic, F.lit(" review")), F.lower(topic)]
    expanded = hits.topic_to_queries(i.topics.select("topic").distinct(), variants)
    return _longs(expanded, "query_idx")


def _search_queries(i: Inputs) -> DataFrame:
    return i.topics.select(F.col("item_id").cast("int").alias("query_idx"), F.col("topic").alias("query"))


@query
def provider_search(i: Inputs) -> DataFrame:
    found = hits.search(i.spark, _search_queries(i), i.providers)
    return _longs(found.select("*", "ord.*").drop("ord"), "query_idx", "source_idx").select(
        "query_idx", "source_idx", "hit_idx", "title", "doi", "url"
    )


@query
def search_and_merge(i: Inputs) -> DataFrame:
    merged = hits.search_and_merge(i.spark, _search_queries(i), i.providers)
    return _longs(merged.select("*", "ord.*").drop("ord"), "query_idx", "source_idx").select(
        "query_idx", "source_idx", "hit_idx", "doi", "title"
    )


@query
def coerced_hits(i: Inputs) -> DataFrame:
    partial = i.hits.select("doc_id", "title", "doi", F.when(F.col("lang") == "en", F.col("year")).alias("year"))
    return _longs(hits.coerce_hits(partial), "year")


@query
def union_sources(i: Inputs) -> DataFrame:
    loaded = [p.load(i.spark).select("title", "doi", "hit_idx") for p in i.providers]
    return _longs(hits.union_sources(loaded), "source_idx")


def _resolved(i: Inputs) -> DataFrame:
    return resolve.resolve(i.hits, i.oa_snapshot, i.pmc_snapshot)


@query
def resolver_chain(i: Inputs) -> DataFrame:
    return _resolved(i).select("doc_id", "doi", "url", "pdf_url", "resolver_source")


@query
def unresolved_hits(i: Inputs) -> DataFrame:
    return resolve.keep_unresolved(_resolved(i)).select("title", "doi", "url", "source")


@query
def resolve_success_rate(i: Inputs) -> DataFrame:
    rate = stats.resolution_rate(_resolved(i))
    return rate.withColumn("success_rate", F.round("success_rate", 6))


@query
def fetch_plan(i: Inputs) -> DataFrame:
    plan = _longs(resolve.fetch_plan(_resolved(i)), "try_no")
    return plan.select(
        "pdf_url", "try_no", "request_url",
        F.col("headers")["Referer"].alias("referer"), F.size("headers").cast("bigint").alias("n_headers"),
    )


@query
def found_papers(i: Inputs) -> DataFrame:
    topics = i.topics.select("topic").distinct()
    found = literature.find_papers(i.spark, topics, i.providers, i.oa_snapshot, i.pmc_snapshot)
    return found.select("doi", "pdf_url", "resolver_source")


# -- de-duplication and statistics --------------------------------------------------------------------


@query
def merge_hits(i: Inputs) -> DataFrame:
    return _longs(dedupe.merge_hits(i.hits), "year").select(*schemas.HIT_COLUMNS, "ord").orderBy("ord")


@query
def unique_urls(i: Inputs) -> DataFrame:
    unique = dedupe.unique_by_url(resolve.keep_resolved(_resolved(i)))
    return unique.select("pdf_url", "resolver_source", "doc_id").orderBy("doc_id")


@query
def drop_processed(i: Inputs) -> DataFrame:
    done = i.hits.join(i.table("labels"), "doc_id", "left_semi").select(F.col("url").alias("pdf_url"))
    return dedupe.drop_processed(i.hits.select("doc_id", F.col("url").alias("pdf_url")), done)


@query
def content_dedup(i: Inputs) -> DataFrame:
    kept, _ = dedupe.split_by_content(i.documents, F.col("text"), "doc_id")
    return kept.select("doc_id", "sha256", "lang")


@query
def content_rejects(i: Inputs) -> DataFrame:
    _, rejects = dedupe.split_by_content(i.documents, F.col("text"), "doc_id")
    return rejects.select("doc_id", "sha256", "reason")


@query
def merge_by_title(i: Inputs) -> DataFrame:
    return dedupe.merge_by_title(i.hits).select("doc_id", "title")


@query
def merge_similar_titles(i: Inputs) -> DataFrame:
    return fuzzy.merge_similar_titles(i.hits).select("doc_id", "title")


@query
def unique_items(i: Inputs) -> DataFrame:
    return stats.unique_items(resolve.keep_resolved(_resolved(i)))


@query
def dedup_ratio(i: Inputs) -> DataFrame:
    ratio = stats.dedup_ratio(resolve.keep_resolved(_resolved(i)), "pdf_url")
    return ratio.withColumn("kept_ratio", F.round("kept_ratio", 6))


@query
def text_stats(i: Inputs) -> DataFrame:
    return stats.text_stats(i.documents, "text", "lang")


@query
def stage_dashboard(i: Inputs) -> DataFrame:
    log = i.table("events").select(
        F.col("event_type").alias("stage"), (F.col("value") < 20).alias("ok"), F.col("ts").alias("at")
    )
    return stats.stage_dashboard(log).withColumn("success_rate", F.round("success_rate", 6))


@query
def topic_digest(i: Inputs) -> DataFrame:
    papers = i.hits.select(F.col("lang").alias("topic"), F.col("doc_id").alias("paper_id"), "title", "year", "score")
    texts = i.documents.select(F.col("doc_id").alias("paper_id"), "text")
    digest = stats.topic_digest_of_texts(papers, texts).select("topic", F.inline("entries"))
    return _longs(digest, "rank", "year").select("topic", "rank", "paper_id", "title", "year", "content")


# -- relevance ------------------------------------------------------------------------------------------


def _titles(i: Inputs) -> DataFrame:
    return i.documents.select(F.col("doc_id").alias("ord"), _title().alias("sentence"))


def _title():
    return F.regexp_extract("text", r"^[^.!?\n]*", 0)


@query
def rank_titles(i: Inputs) -> DataFrame:
    return ranking.rank_sentences(_titles(i), RANK_QUERY).withColumn("score", F.round("score", 6))


@query
def relevance_filter(i: Inputs) -> DataFrame:
    kept = ranking.semantic_filter(_titles(i), RANK_QUERY, threshold=0.35)
    return kept.withColumn("score", F.round("score", 6))


@query
def rank_passages(i: Inputs) -> DataFrame:
    passages = i.table("benchmark").withColumnRenamed("item_id", "ord")
    return ranking.rank_documents(passages, RANK_QUERY).withColumn("score", F.round("score", 6))


@query
def top_titles_per_query(i: Inputs) -> DataFrame:
    queries = i.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    top = ranking.top_sentences(_titles(i), queries, k=5)
    return _longs(top, "rank").withColumn("score", F.round("score", 6))


@query
def rank_pairs(i: Inputs) -> DataFrame:
    """Every title against the rest of its own text."""
    rest = F.substr("text", F.length("title") + 1)
    pairs = i.documents.withColumn("title", _title()).select("doc_id", F.col("title").alias("query"), rest.alias("sentence"))
    return ranking.rank_pairs(pairs).select("doc_id", F.round("score", 6).alias("score"))


def _shared_letters_words():
    """A pair model: the words in both texts among the words in either."""

    def predict(queries, texts):
        own = lambda text: set(re.findall("[A-Za-z]+", text))
        pairs = [(own(q), own(t)) for q, t in zip(queries, texts)]
        return [len(a & b) / len(a | b) if a | b else 0.0 for a, b in pairs]

    return predict


@query
def rank_titles_by_model(i: Inputs) -> DataFrame:
    ranked = ranking.rank_sentences(_titles(i), RANK_QUERY, scorer=ranking.model_scorer(_shared_letters_words))
    return ranked.withColumn("score", F.round("score", 6))


# -- text ---------------------------------------------------------------------------------------------


@query
def clean_text(i: Inputs) -> DataFrame:
    cleaned = tx.collapse_whitespace(F.col("text"))
    return i.documents.select(
        "doc_id", tx.sha256_hex(cleaned).alias("clean_sha256"), F.length(cleaned).cast("bigint").alias("clean_chars"),
        tx.token_estimate(F.col("text")).cast("bigint").alias("tokens"),
    )


@query
def html_text(i: Inputs) -> DataFrame:
    return i.pages.select("page_id", tx.strip_html(F.col("html")).alias("text"))


@query
def assembled_turns(i: Inputs) -> DataFrame:
    return _longs(documents.assemble_chunks(i.table("conversations"), "conv_id", "turn", "text"), "chunk_no")


@query
def opening_of_turns(i: Inputs) -> DataFrame:
    chunks = documents.assemble_chunks(i.table("conversations"), "conv_id", "turn", "text")
    return documents.text_parts(chunks, "conv_id")


@query
def empty_text_rejects(i: Inputs) -> DataFrame:
    texts = i.pages.withColumn("body", F.regexp_extract("html", r"(?s)<h2[^>]*>(.*?)</h2>", 1))
    return documents.split_empty(texts, "body", "page_id")[1]


@query
def chunks_4000(i: Inputs) -> DataFrame:
    return _longs(documents.chunk_text(i.documents, "text", "doc_id"), "chunk_no")


@query
def section_slices(i: Inputs) -> DataFrame:
    return _longs(documents.sections(i.documents, "text", "doc_id"), "part_no")


@query
def prompt_table(i: Inputs) -> DataFrame:
    return _longs(documents.prompts(i.documents, "text", "doc_id"), "max_tokens", "chunk_no")


@query
def extractive_summaries(i: Inputs) -> DataFrame:
    return documents.extractive_summaries(i.documents, "text", "doc_id")


@query
def complete_summaries(i: Inputs) -> DataFrame:
    texts = documents.extractive_summaries(i.documents, "text", "doc_id")
    longer = written(texts.filter(F.length("content") >= 40), "summaries")
    complete, _ = documents.keep_complete(longer, "doc_id", wanted=len(documents.PROMPTS))
    return complete.select("doc_id", "summary_type")


@query
def document_keywords(i: Inputs) -> DataFrame:
    found = documents.keywords(i.documents, "text", "doc_id")
    return _longs(found, "rank").withColumn("weight", F.round("weight", 6))


@query
def metadata_fields(i: Inputs) -> DataFrame:
    found = documents.metadata_fields(i.documents, "text", "doc_id")
    lists = {c: F.array_join(c, "|") for c in ("authors", "institutions")}
    return _longs(found.withColumns(lists), "citations", "sample_size")


@query
def metadata_rows(i: Inputs) -> DataFrame:
    extracted = documents.extract_metadata(i.documents, "text", "doc_id")
    return documents.metadata_rows(extracted, "doc_id")


# -- vectors --------------------------------------------------------------------------------------------


def _similarity_digits(df: DataFrame) -> DataFrame:
    return df.withColumn("similarity", F.round("similarity", 6))


@query
def find_similar_papers(i: Inputs) -> DataFrame:
    found = vector_search.find_similar_papers(i.vectors, i.titled, i.vector(0), similarity_threshold=0.2)
    return _similarity_digits(found)


@query
def find_similar_best_per_paper(i: Inputs) -> DataFrame:
    by_group = i.vectors.withColumn("paper_id", F.col("label").cast("bigint"))
    found = vector_search.find_similar_papers(by_group, i.titled, i.vector(0), 0.2, best_per_paper=True)
    return _similarity_digits(found)


@query
def find_similar_by_type(i: Inputs) -> DataFrame:
    found = vector_search.find_similar_papers(i.vectors, i.titled, i.vector(0), 0.1, embedding_type="abstract")
    return _similarity_digits(found)


@query
def find_similar_sql(i: Inputs) -> DataFrame:
    i.vectors.createOrReplaceTempView("quillmill_vectors")
    i.titled.createOrReplaceTempView("quillmill_titled")
    vec.register_find_similar_papers(i.spark, "quillmill_vectors", "quillmill_titled")
    asked = ", ".join(f"{x!r}D" for x in i.vector(0))
    found = i.spark.sql(
        f"SELECT * FROM find_similar_papers(array({asked}), 0.2) ORDER BY similarity DESC, paper_id LIMIT 10"
    )
    return _similarity_digits(found)


@query
def cosine_to_centre(i: Inputs) -> DataFrame:
    centres = i.label_centres.select(F.col("query_id").alias("label"), F.col("embedding").alias("centre"))
    paired = i.vectors.withColumn("label", F.col("label").cast("bigint")).join(centres, "label")
    return paired.select(
        "paper_id", "label",
        F.round(vec.cosine_similarity(F.col("embedding"), F.col("centre")), 6).alias("similarity"),
        F.round(vec.cosine_distance(F.col("embedding"), F.col("centre")), 6).alias("distance"),
    )


@query
def nearest_chunks(i: Inputs) -> DataFrame:
    chunks = i.table("embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    found = vector_search.nearest_chunks(chunks, i.vector(0))
    return found.select("chunk_id", F.round("distance", 6).alias("distance"))


@query
def search_many(i: Inputs) -> DataFrame:
    found = vector_search.search_many(i.vectors, i.label_centres, k=10)
    return _longs(_similarity_digits(found), "rank")


@query
def ivf_search_all_cells(i: Inputs) -> DataFrame:
    model = vector_search.train_cells(i.vectors, cells=16)
    placed = vector_search.assign_cells(i.vectors, model)
    return _similarity_digits(vector_search.search_cells(placed, model, i.vector(0), probes=16))


@query
def ivf_search(i: Inputs) -> DataFrame:
    asked = i.vectors.filter(F.col("paper_id") == 0).select(F.col("paper_id").alias("query_id"), "embedding")
    found = _by_cells(i, asked)
    return _similarity_digits(found).select("paper_id", "similarity")


@query
def ivf_search_many(i: Inputs) -> DataFrame:
    return _longs(_similarity_digits(_by_cells(i, _asked_vectors(i))), "rank")


@query
def ivf_recall(i: Inputs) -> DataFrame:
    exact = vector_search.search_many(i.vectors, _asked_vectors(i), k=10)
    return vector_search.recall(_by_cells(i, _asked_vectors(i)), exact, ["query_id", "paper_id"])


def _asked_vectors(i: Inputs) -> DataFrame:
    """Every hundredth vector as a query."""
    chosen = i.vectors.filter(F.col("paper_id") % 100 == 0)
    return chosen.select(F.col("paper_id").alias("query_id"), "embedding")


def _by_cells(i: Inputs, queries: DataFrame) -> DataFrame:
    index = cells.train_index(i.vectors, cells=16, words=32, parts=16, rounds=3)
    path = work_dir(i.spark, "cells")
    cells.place(i.vectors, index).write.partitionBy("cell").parquet(path)
    return cells.search_index(i.spark.read.parquet(path), i.vectors, queries, index, probes=14, refine=16)


@query
def parsed_vectors(i: Inputs) -> DataFrame:
    """The vectors as text and back; every tenth text is cut short, which gives no vector."""
    text = F.to_json("embedding")
    text = F.when(F.col("paper_id") % 10 == 3, F.concat(F.lit("["), F.substr(text, F.lit(3), F.lit(9)), F.lit("x"))).otherwise(text)
    parsed = i.vectors.select("paper_id", vec.parse_vector(text).alias("v"))
    return parsed.select(
        "paper_id", F.when(F.col("v").isNotNull(), F.size("v")).cast("bigint").alias("dims"), F.round(vec.norm(F.col("v")), 5).alias("length"),
    )


def _vowel_counts():
    """An embedding model: how often each vowel comes; it fails on texts without any."""
    return lambda texts: [[float(t.count(c)) for c in "aeiou"] if any(c in t for c in "aeiou") else None for t in texts]


@query
def embed_by_model(i: Inputs) -> DataFrame:
    parts = i.documents.select("doc_id", F.lit("full_text").alias("embedding_type"), F.col("text").alias("section_text"), F.lit(0).alias("part_no"))
    done, _ = vector_search.embed_sections(parts, vector_search.model_embedder(_vowel_counts), "doc_id")
    return done.select("doc_id", *[F.col("embedding")[n].cast("double").alias(c) for n, c in enumerate("aeiou")])


@query
def wrong_dimension(i: Inputs) -> DataFrame:
    return _longs(vector_search.wrong_dimension(i.vectors, schemas.CHUNK_VECTOR_DIM), "dims").select("paper_id", "dims")


@query
def embed_sections(i: Inputs) -> DataFrame:
    rows = documents.sections(i.documents, "text", "doc_id")
    done, _ = vector_search.embed_sections(rows, vector_search.hash_embedder(256), "doc_id")
    return done.select(
        "doc_id", "embedding_type", F.size("embedding").cast("bigint").alias("dims"),
        F.round(vec.norm(F.col("embedding")), 4).alias("length"),
    )


# -- table edits ------------------------------------------------------------------------------------------


def _papers_out(df: DataFrame) -> DataFrame:
    flat = df.withColumn("authors", F.array_join("authors", "|")).drop("file_path")
    return _longs(flat, "year")


@query
def upsert_papers(i: Inputs) -> DataFrame:
    return _papers_out(store.upsert_papers(i.papers, i.incoming_papers, stamp(AS_OF)))


@query
def upsert_papers_stored(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "papers")
    keys, buckets = ["doi"], 8
    held = tables.Store(path, {"papers": tables.Table(i.papers.schema, keys, "id")}, buckets)
    held.create(i.spark)
    batch = held.begin(i.spark)
    batch.replace("papers", i.papers)
    batch.edit("papers", i.incoming_papers, lambda old, new: store.upsert_papers(old, new, stamp(AS_OF), max_id=batch.last_id("papers")))
    batch.commit()
    return _papers_out(held.read(i.spark, "papers"))


def _stored_works(i: Inputs) -> tables.Store:
    """Works and their children as stored tables, the children keyed by what they point with."""
    before = {"works": (i.works, "work_id"), "files": (i.files, "work_id"), "chunks": (i.chunks, "file_id"),
              "file_summaries": (i.file_summaries, "file_id"), "ingest_queue": (i.file_jobs, "file_id")}
    held = tables.Store(work_dir(i.spark, "works"), {n: tables.Table(df.schema, [key]) for n, (df, key) in before.items()}, 8)
    held.create(i.spark)
    batch = held.begin(i.spark)
    for name, (df, _) in before.items():
        batch.replace(name, df)
    batch.commit()
    return held


@query
def delete_works_stored(i: Inputs) -> DataFrame:
    """A cascade over stored tables: in each one the buckets of the dead keys are rewritten, and all tables change together."""
    held = _stored_works(i)
    batch = held.begin(i.spark)
    store.delete_cascade(batch, "works", "work_id", _dead_works(i), store.WORK_CHILDREN)
    batch.commit()
    return _counted({name: held.read(i.spark, name) for name in held.tables})


@query
def delete_papers_stored(i: Inputs) -> DataFrame:
    """The labelled papers with their vectors as stored tables, without those labelled toxic."""
    vectors = i.vectors.select("paper_id", "embedding_type", F.size("embedding").alias("dims"))
    kept = {"papers": (i.papers, ["id"]), "embeddings": (vectors, ["paper_id"])}
    held = tables.Store(work_dir(i.spark, "papers"), {n: tables.Table(df.schema, keys) for n, (df, keys) in kept.items()}, 8)
    held.create(i.spark)
    batch = held.begin(i.spark)
    for name, (df, _) in kept.items():
        batch.replace(name, df)
    batch.commit()
    batch = held.begin(i.spark)
    toxic = i.table("labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    store.delete_cascade(batch, "papers", "id", toxic, [store.Child("embeddings", "paper_id", "papers", "id")])
    batch.commit()
    left = held.read(i.spark, "papers").select(F.lit("papers").alias("table"), "id", F.lit("").alias("kind"))
    return left.unionByName(held.read(i.spark, "embeddings").select(
        F.lit("embeddings").alias("table"), F.col("paper_id").alias("id"), F.col("embedding_type").alias("kind")))


def _incoming_summaries(i: Inputs) -> DataFrame:
    kind = F.when(F.col("lang") == "en", "executive").otherwise("methodology")
    return i.hits.select("doi", kind.alias("summary_type"), F.col("title").alias("content"), "ord")


def _summaries(i: Inputs) -> DataFrame:
    return i.papers.select(
        "id", F.col("id").alias("paper_id"), F.lit("executive").alias("summary_type"), F.lit("old").alias("content"),
        "created_at", "updated_at",
    )


@query
def resolve_paper_ids(i: Inputs) -> DataFrame:
    latest = store.latest_incoming(_incoming_summaries(i), ["doi", "summary_type"], "ord")
    return store.resolve_paper_ids(latest, i.papers).select("paper_id", "summary_type", "content", "ord")


@query
def upsert_summaries(i: Inputs) -> DataFrame:
    return store.upsert_summaries(_summaries(i), _incoming_summaries(i), i.papers, stamp(AS_OF))


@query
def upsert_embeddings(i: Inputs) -> DataFrame:
    present = i.papers.select(
        "id", F.col("id").alias("paper_id"), F.lit("title").alias("embedding_type"),
        F.array(F.lit(0.0).cast("float")).alias("embedding"), "created_at",
    )
    vectors = i.table("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    kind = F.when(F.col("lang") == "en", "title").otherwise("abstract")
    incoming = i.hits.join(vectors, "doc_id").select("doi", kind.alias("embedding_type"), "embedding", "ord")
    after = store.upsert_embeddings(present, incoming, i.papers, stamp(AS_OF))
    return after.select(
        "id", "paper_id", "embedding_type", F.size("embedding").cast("bigint").alias("dims"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), "created_at",
    )


@query
def upsert_metadata(i: Inputs) -> DataFrame:
    present = i.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("paper_id"), F.lit("view").alias("key"),
        F.to_json(F.struct("c_mktsegment")).alias("value"),
        stamp(CREATED).alias("created_at"), stamp(CREATED).alias("updated_at"),
    )
    incoming = i.table("events").select(
        F.col("user_id").alias("paper_id"), F.col("event_type").alias("key"), F.col("props").alias("value"),
        F.col("event_id").alias("ord"),
    )
    return store.upsert_metadata(present, incoming, stamp(AS_OF))


@query
def insert_if_absent(i: Inputs) -> DataFrame:
    incoming = i.incoming_papers.withColumn("authors", F.array(F.lit("new")))
    return _papers_out(store.insert_if_absent(i.papers, incoming, ["doi"], stamp(AS_OF)))


def _new_edges(i: Inputs) -> tuple[DataFrame, DataFrame]:
    present = i.edges.filter(F.col("relationship_type") == "cites").select(
        (F.col("source_paper_id") * 1_000_000 + F.col("target_paper_id")).alias("id"), "*", stamp(CREATED).alias("created_at")
    )
    lines = i.table("lineitem")
    raw = lines.select(
        F.col("l_partkey").alias("source_paper_id"), F.col("l_suppkey").alias("target_paper_id"),
        F.when(F.col("l_linestatus") == "O", "cites").otherwise("cited_by").alias("relationship_type"),
        F.col("l_discount").alias("confidence"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_line"), "l_quantity", "l_extendedprice",
    )
    keys = ["source_paper_id", "target_paper_id", "relationship_type", "order_line"]
    incoming = tables.dealt_out(raw, lines.count(), *keys).groupBy(*keys).agg(F.max("confidence").alias("confidence"))
    return present, incoming.withColumn("ord", F.col("order_line")).drop("order_line")


@query
def insert_edges(i: Inputs) -> DataFrame:
    after, _ = store.insert_edges(*_new_edges(i), stamp(AS_OF))
    return after.select("id", "source_paper_id", "target_paper_id", "relationship_type", "confidence", "created_at")


@query
def edge_conflicts(i: Inputs) -> DataFrame:
    _, conflicts = store.insert_edges(*_new_edges(i), stamp(AS_OF))
    return conflicts.select("source_paper_id", "target_paper_id", "relationship_type", "confidence", "ord", "reason")


@query
def create_rows(i: Inputs) -> DataFrame:
    incoming = i.table("orders").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("ingest_id"), F.col("o_orderpriority").alias("file_id"),
        F.when(F.col("o_orderstatus") == "F", "done").alias("status"),
    )
    defaults = {"status": F.lit("pending"), "retries": F.lit(0), "updated_at": stamp(AS_OF)}
    return _longs(store.create_rows(i.queue, incoming, defaults), "retries")


@query
def patch_rows(i: Inputs) -> DataFrame:
    patches = i.table("orders").select(
        F.col("o_custkey").alias("work_id"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("title")))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit("segment")))
        .otherwise(F.array(F.lit("title"), F.lit("segment"))).alias("fields"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"),
        F.col("o_orderstatus").alias("segment"),
    )
    present = i.table("customer").select(
        F.col("c_custkey").alias("work_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment")
    )
    return store.patch_rows(present, patches, "work_id", ["title", "segment"], order="ord")


def _dead_works(i: Inputs) -> DataFrame:
    return i.table("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("work_id"))


@query
def delete_rows(i: Inputs) -> DataFrame:
    return store.delete_rows(i.files, _dead_works(i), "work_id")[0]


@query
def delete_report(i: Inputs) -> DataFrame:
    asked = i.table("customer").select(F.col("c_custkey").alias("work_id"))
    return store.delete_rows(i.files, asked, "work_id")[1]


@query
def cascade_delete(i: Inputs) -> DataFrame:
    before = {"works": i.works, "files": i.files, "chunks": i.chunks, "file_summaries": i.file_summaries, "ingest_queue": i.file_jobs}
    return _counted(store.cascade_delete(before, "works", "work_id", _dead_works(i), store.WORK_CHILDREN))


def _counted(after: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.select(F.lit(name).alias("table"), F.col("work_id" if name == "works" else "file_id").alias("key"))
        for name, df in after.items()
    ]
    united = rows[0]
    for part in rows[1:]:
        united = united.unionByName(part)
    return united.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))


def _saved(i: Inputs) -> tuple[DataFrame, DataFrame]:
    works = i.spark.createDataFrame([], schemas.WORKS.replace("created_at timestamp", "created_at timestamp_ntz"))
    found = i.spark.createDataFrame([], schemas.SEARCH_HITS)
    return store.save_hits(works, found, i.hits, "a topic", stamp(AS_OF))


@query
def save_hits_works(i: Inputs) -> DataFrame:
    return _saved(i)[0].select("doi", "title", F.length("work_id").cast("bigint").alias("id_chars"), "created_at")


@query
def save_hits(i: Inputs) -> DataFrame:
    works, found = _saved(i)
    joined = found.join(works.select("work_id", "doi"), "work_id", "left")
    shared = F.count("*").over(Window.partitionBy("hit_id"))
    return joined.select("doi", "url", "provider", "topic", shared.alias("hits_with_this_id"))


@query
def save_hits_again(i: Inputs) -> DataFrame:
    """Saving the same hits a second time adds search hits, but no work."""
    works, found = _saved(i)
    return store.save_hits(works, found, i.hits, "a topic", stamp(CREATED))[0].select("doi", "created_at")


@query
def serial_ids(i: Inputs) -> DataFrame:
    return assign_ids(i.table("orders").select("o_orderkey", "o_custkey"), "o_custkey", "id", 1000, ties=["o_orderkey"])


# -- constraints, lookups, joins ---------------------------------------------------------------------------


@query
def unique_violations(i: Inputs) -> DataFrame:
    return constraints.unique_violations(i.hits, ["doi"])


@query
def null_violations(i: Inputs) -> DataFrame:
    bad = constraints.null_violations(i.hits, ["title", "doi", "year"])
    return bad.select("doc_id", F.array_join("missing", ",").alias("missing"))


@query
def fk_violations(i: Inputs) -> DataFrame:
    bad = constraints.foreign_key_violations(i.vectors, "paper_id", i.table("labels"), "doc_id")
    return bad.select("paper_id", "embedding_type")


@query
def enum_violations(i: Inputs) -> DataFrame:
    return constraints.enum_violations(i.edges, "relationship_type", ["cites", "cited_by"])


@query
def violation_counts(i: Inputs) -> DataFrame:
    named = {"papers": i.papers, "paper_relationships": i.edges}
    return constraints.violation_counts(named)


@query
def seen_before(i: Inputs) -> DataFrame:
    seen, _ = lookups.seen_before(i.hits, i.papers, _search_hits(i))
    return seen.select("doc_id", "doi", "url")


@query
def unseen_hits(i: Inputs) -> DataFrame:
    _, fresh = lookups.seen_before(i.hits, i.papers, _search_hits(i))
    return fresh.select("doc_id", "doi", "url")


def _search_hits(i: Inputs) -> DataFrame:
    return i.hits.join(i.table("labels"), "doc_id", "left_semi").select("url")


@query
def rows_by_key(i: Inputs) -> DataFrame:
    return lookups.by_key(i.files, work_id=7)


@query
def first_by_key(i: Inputs) -> DataFrame:
    return lookups.first_by(i.works, work_id=7)


@query
def page_of_rows(i: Inputs) -> DataFrame:
    return lookups.page(i.files, "file_id", skip=50, limit=100)


@query
def pending_items(i: Inputs) -> DataFrame:
    return _longs(lookups.pending(i.queue), "retries")


@query
def work_tree(i: Inputs) -> DataFrame:
    return lookups.work_tree(i.works, i.files, i.chunks, i.file_summaries, i.file_jobs)


# -- graph and metadata ----------------------------------------------------------------------------------


@query
def out_neighbours(i: Inputs) -> DataFrame:
    return graph.out_neighbours(i.edges, i.supplier_papers, 42)


@query
def in_neighbours(i: Inputs) -> DataFrame:
    return graph.in_neighbours(i.edges, i.part_papers, 3)


@query
def all_out_neighbours(i: Inputs) -> DataFrame:
    return graph.out_neighbours(i.edges, i.supplier_papers)


@query
def edges_by_type(i: Inputs) -> DataFrame:
    return graph.edges_where(i.edges, "cites", 0.05)


@query
def metadata_of(i: Inputs) -> DataFrame:
    return graph.metadata_of(i.event_metadata, 7)


@query
def metadata_values(i: Inputs) -> DataFrame:
    return graph.metadata_values(i.event_metadata, "$.k", "bigint").select("paper_id", "key", "typed")


@query
def metadata_pivot(i: Inputs) -> DataFrame:
    return graph.metadata_pivot(i.event_metadata, ["view", "click", "error"])


# -- ingest state and streams ---------------------------------------------------------------------------


@query
def ingest_state(i: Inputs) -> DataFrame:
    return ingest.fold_status_events(i.status_events)


@query
def apply_status_events(i: Inputs) -> DataFrame:
    return _longs(ingest.apply_status_events(i.queue, i.status_events, stamp(AS_OF)), "retries")


@query
def retry_schedule(i: Inputs) -> DataFrame:
    attempts = i.table("events").select(
        F.concat_ws("/", F.col("user_id"), F.get_json_object("props", "$.k")).alias("pdf_url"),
        (F.col("event_type") == "purchase").alias("ok"), F.col("ts").alias("at"),
    )
    return ingest.retry_schedule(attempts)


@query
def stream_unique_urls(i: Inputs) -> DataFrame:
    """Event payloads as URLs: a stream with many repeats."""
    events = _table_stream(i, "events")
    urls = events.select(F.concat_ws("/", "event_type", F.get_json_object("props", "$.k")).alias("pdf_url"))
    output = work_dir(i.spark, "urls")
    jobs.append_unique(urls, output, work_dir(i.spark, "progress")).awaitTermination()
    return i.spark.read.schema("pdf_url string").parquet(output)


@query
def stream_status(i: Inputs) -> DataFrame:
    events = _table_stream(i, "events")
    reports = events.select(
        F.col("user_id").alias("ingest_id"), F.col("event_id").alias("ord"), F.col("event_type").alias("status"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("code "), F.get_json_object("props", "$.k"))).alias("error"),
    )
    output = work_dir(i.spark, "status")
    jobs.status_stream(reports, output, work_dir(i.spark, "progress")).awaitTermination()
    return tables.read_table(i.spark, output, jobs.STATUS_STATE)


def _page_landing(i: Inputs) -> DataFrame:
    pages = _table_stream(i, "pages")
    return pages.select(
        F.concat(F.lit("10.1000/"), F.col("page_id").cast("string")).alias("doi"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.lit(2024).alias("year"), F.lit("web").alias("source"), F.col("url").alias("pdf_url"),
        F.when(F.col("html").contains("lang=\"fr\""), 403).otherwise(200).alias("status"),
        F.col("html").cast("binary").alias("content"), F.col("page_id").alias("ord"),
    )


def _run_flow(i: Inputs) -> jobs.IngestFlow:
    flow = jobs.IngestFlow(work_dir(i.spark, "store"), buckets=8, embedder=vector_search.hash_embedder(64))
    flow.create(i.spark)
    flow.start(_page_landing(i), work_dir(i.spark, "progress")).awaitTermination()
    return flow


@query
def stream_ingest_papers(i: Inputs) -> DataFrame:
    stored = _run_flow(i).table(i.spark, "papers")
    return _longs(stored, "year").select("doi", "title", "year", "pdf_url", "sha256", "source")


@query
def stream_ingest_children(i: Inputs) -> DataFrame:
    flow = _run_flow(i)
    dois = flow.table(i.spark, "papers").select(F.col("id").alias("paper_id"), "doi")
    summaries = flow.table(i.spark, "summaries").select("paper_id", F.col("summary_type").alias("kind"), "content")
    dims = F.concat_ws(" ", F.size("embedding"), F.lit("numbers"))
    vectors = flow.table(i.spark, "embeddings").select("paper_id", F.col("embedding_type").alias("kind"), dims.alias("content"))
    return summaries.unionByName(vectors).join(dois, "paper_id").select("doi", "kind", "content")


@query
def stream_ingest_dashboard(i: Inputs) -> DataFrame:
    dashboard = stats.stage_dashboard(_run_flow(i).stage_log(i.spark))
    return dashboard.select("stage", "items", "succeeded")


@query
def stream_ingest_metadata(i: Inputs) -> DataFrame:
    flow = _run_flow(i)
    dois = flow.table(i.spark, "papers").select(F.col("id").alias("paper_id"), "doi")
    return flow.table(i.spark, "paper_metadata").select("paper_id", "key", "value").join(dois, "paper_id").select("doi", "key", "value")


@query
def stream_fetch_outcomes(i: Inputs) -> DataFrame:
    """Every event as an attempt to fetch the URL that user and payload name: what became of each URL."""
    events = _table_stream(i, "events", max_files=1_000_000)
    ok = F.col("event_type").isin("purchase", "signup")
    attempts = events.select(
        F.concat_ws("/", F.col("user_id"), F.get_json_object("props", "$.k")).alias("pdf_url"),
        F.when(ok, 200).when(F.col("event_type") == "error", 403).otherwise(404).alias("status"),
        F.col("event_id").alias("ord"), F.col("ts").cast("timestamp").alias("at"),
    )
    output = work_dir(i.spark, "outcomes")
    told = fetches.fetch_outcomes(attempts).writeStream.format("parquet").option("checkpointLocation", work_dir(i.spark, "progress"))
    told.outputMode("append").trigger(availableNow=True).start(output).awaitTermination()
    found = i.spark.read.schema(f"pdf_url string, status int, ord bigint, at timestamp, {fetches.OUTCOME}").parquet(output)
    return _longs(found, "status", "attempts").withColumn("next_at", F.col("next_at").cast("timestamp_ntz")).drop("at")


@query
def stream_store_files(i: Inputs) -> DataFrame:
    output = work_dir(i.spark, "files")
    jobs.store_files(_page_landing(i), output, work_dir(i.spark, "progress")).awaitTermination()
    return i.spark.read.parquet(output).select("sha256", "file_path", "size")


def _table_stream(i: Inputs, name: str, **options) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files.

    The bracket makes the path a pattern: Spark takes a plain path for a folder, and a file filter sees file names only.
    """
    return jobs.landing_stream(i.spark, f"{i.folder.rstrip('/')}/{name}.parque[t]", _ddl(i, name), **options)


def _ddl(i: Inputs, name: str) -> str:
    return ", ".join(f"{column} {kind}" for column, kind in i.table(name).dtypes)


@query
def topic_to_papers(i: Inputs) -> DataFrame:
    """The whole job from topics to stored papers, the documents' texts standing for fetched bodies."""
    flow = jobs.IngestFlow(
        work_dir(i.spark, "store"), buckets=8, embedder=vector_search.hash_embedder(64),
        parse=lambda content: tx.collapse_whitespace(content.cast("string")),
    )
    flow.create(i.spark)
    resolved = resolve.keep_resolved(_resolved(i))
    located = dedupe.unique_by_url(resolved).select("pdf_url", "doc_id")
    bodies = located.join(i.documents.select("doc_id", "text"), "doc_id")
    fetch_log = bodies.select(
        "pdf_url", F.lit(1).alias("attempt"), F.lit(200).alias("status"), F.col("text").cast("binary").alias("content"),
        stamp(AS_OF).alias("at"),
    )
    topics = i.topics.select("topic").distinct()
    literature.run(i.spark, topics, i.providers, i.oa_snapshot, i.pmc_snapshot, fetch_log, flow)
    return flow.table(i.spark, "papers").select("doi", "pdf_url", "sha256", "source")
