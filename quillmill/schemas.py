"""Declared schemas of the records and tables (Spark DDL)."""

from __future__ import annotations

HIT = "title string, doi string, url string, year int, source string, score double"
HIT_COLUMNS = ["title", "doi", "url", "year", "source", "score"]
HIT_ORDER = "struct<query_idx:int,source_idx:int,hit_idx:bigint>"

RESOLVED_COLUMNS = HIT_COLUMNS + ["pdf_url", "resolver_source"]

OA_SNAPSHOT = "doi string, best_oa_location struct<url_for_pdf:string>"
PMC_SNAPSHOT = "doi string, rank int, pmcid string"

FETCH_LOG = "pdf_url string, attempt int, status int, content binary, at timestamp"

# Paper store
PAPERS = (
    "id bigint, doi string, title string, authors array<string>, year int, pdf_url string, "
    "file_path string, sha256 string, source string, created_at timestamp, updated_at timestamp"
)
SUMMARIES = (
    "id bigint, paper_id bigint, summary_type string, content string, "
    "created_at timestamp, updated_at timestamp"
)
EMBEDDINGS = (
    "id bigint, paper_id bigint, embedding_type string, embedding array<float>, created_at timestamp"
)
PAPER_RELATIONSHIPS = (
    "id bigint, source_paper_id bigint, target_paper_id bigint, relationship_type string, "
    "confidence double, created_at timestamp"
)
PAPER_METADATA = (
    "id bigint, paper_id bigint, key string, value string, created_at timestamp, updated_at timestamp"
)

# Document store; its summaries table is called file_summaries here, as both stores have one
WORKS = "work_id string, doi string, title string, year int, authors array<string>, created_at timestamp"
FILES = (
    "file_id string, work_id string, uri string, sha256 string, mime_type string, size_bytes bigint, "
    "num_pages int, licence string, ingested_at timestamp"
)
CHUNKS = (
    "chunk_id string, file_id string, page_from int, page_to int, text string, "
    "embedding array<float>, created_at timestamp"
)
FILE_SUMMARIES = "summary_id string, file_id string, kind string, summary_text string, generated_at timestamp"
INGEST_QUEUE = (
    "ingest_id bigint, file_id string, status string, retries int, last_error string, updated_at timestamp"
)
SEARCH_HITS = "hit_id string, work_id string, url string, provider string, topic string"

# Fixed values of the data model
SUMMARY_KINDS = ["tl_dr", "abstract", "section"]
RELATIONSHIP_TYPES = ["cites", "cited_by", "related_to"]
PAPER_VECTOR_DIM = 1536
CHUNK_VECTOR_DIM = 768

# What identifies a row, per table
UNIQUE_KEYS = {
    "papers": [["doi"], ["sha256"]],
    "summaries": [["paper_id", "summary_type"]],
    "embeddings": [["paper_id", "embedding_type"]],
    "paper_relationships": [["source_paper_id", "target_paper_id", "relationship_type"]],
    "paper_metadata": [["paper_id", "key"]],
    "works": [["work_id"], ["doi"]],
    "files": [["file_id"], ["sha256"]],
    "file_summaries": [["summary_id"], ["file_id"]],
    "ingest_queue": [["ingest_id"]],
}
REQUIRED_COLUMNS = {
    "papers": ["id", "title"],
    "summaries": ["summary_type", "content"],
    "embeddings": ["embedding_type"],
    "paper_relationships": ["relationship_type"],
    "paper_metadata": ["key"],
    "files": ["work_id", "uri", "sha256", "mime_type", "size_bytes"],
    "chunks": ["file_id", "page_from", "page_to", "text"],
    "file_summaries": ["file_id", "kind", "summary_text"],
    "ingest_queue": ["file_id", "status", "retries"],
}
