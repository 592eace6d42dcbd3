from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators import graph, ingest, stats



def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_neighbours(spark, rows):
    edges = spark.createDataFrame([(1, 2, "cites", 0.9), (1, 3, "related_to", None), (2, 1, "cites", 0.2), (1, 99, "cites", 1.0)],
                                  "source_paper_id bigint, target_paper_id bigint, relationship_type string, confidence double")
    papers = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id bigint, title string")
    assert [r[1] for r in rows(graph.out_neighbours(edges, papers, 1))] == [2, 3]
    assert [r[1] for r in rows(graph.in_neighbours(edges, papers, 1))] == [2]
    assert graph.out_neighbours(edges, papers).count() == 3
    assert rows(graph.edges_where(edges, "cites", 0.5).select("target_paper_id")) == [(2,), (99,)]
    assert graph.edges_where(edges, min_confidence=0.0).count() == 3


def test_metadata_values(spark):
    df = spark.createDataFrame(
        [(1, "keywords", '["a","b"]'), (1, "abstract", '"text"'), (1, "citations", "42"), (2, "citations", "{broken"), (2, "abstract", None)],
        "paper_id bigint, key string, value string",
    )
    typed = lambda kind, key: {r["paper_id"]: r["typed"] for r in graph.metadata_values(df.filter(F.col("key") == key), "$", kind).collect()}
    assert typed("int", "citations") == {1: 42, 2: None}
    assert typed("string", "abstract") == {1: "text", 2: None}
    assert typed("array<string>", "keywords") == {1: ["a", "b"]}
    pivot = {r["paper_id"]: (r["abstract"], r["citations"]) for r in graph.metadata_pivot(df, ["abstract", "citations"]).collect()}
    assert pivot == {1: ('"text"', "42"), 2: (None, "{broken")}
    assert graph.metadata_of(df, 1, "citations").first()["value"] == "42"


def test_reports(spark, rows):
    df = spark.createDataFrame([("u1",), ("u1",), ("u2",), (None,)], "pdf_url string")
    assert rows(stats.unique_items(df)) == [(2,)]
    assert rows(stats.dedup_ratio(df, "pdf_url")) == [(4, 2, 0.5)]
    texts = spark.createDataFrame([("a", "x" * 4001), ("a", ""), ("b", "y")], "g string, t string")
    assert rows(stats.text_stats(texts, "t", "g")) == [("a", 2, 4001, 4001, 2), ("b", 1, 1, 1, 1)]
    papers = spark.createDataFrame([("t", i, f"p{i}", 2000 + i, float(i // 2)) for i in range(6)], "topic string, paper_id bigint, title string, year int, score double")
    summaries = spark.createDataFrame([(5, "executive", "five"), (5, "methodology", "no")], "paper_id bigint, summary_type string, content string")
    entries = stats.topic_digest(papers, summaries, k=3).first()["entries"]
    assert [(e["paper_id"], e["content"]) for e in entries] == [(5, "five"), (4, None), (3, None)]


def test_status_events(spark):
    queue = spark.createDataFrame([(1, "f", "pending", 1, "before", None), (2, "g", "pending", 0, None, None)], schemas.INGEST_QUEUE)
    events = spark.createDataFrame(
        [(1, 3, "done", ""), (1, 1, "failed", "e1"), (1, 2, "failed", "e2"), (1, 4, "stored", None), (9, 1, "x", "y")],
        "ingest_id bigint, ord bigint, status string, error string",
    )
    got = {r["ingest_id"]: r for r in ingest.apply_status_events(queue, events, now()).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1]["status"], got[1]["retries"], got[1]["last_error"]) == ("stored", 3, "e2") and got[1]["updated_at"]
    assert (got[2]["status"], got[2]["retries"], got[2]["updated_at"]) == ("pending", 0, None)


def test_retry_schedule(spark):
    start = datetime(2024, 1, 1)
    rows = [("a", False, start), ("b", False, start), ("b", False, start + timedelta(seconds=5)), ("d", False, start), ("d", True, start)]
    rows += [("c", False, start + timedelta(seconds=i)) for i in range(3)]
    df = spark.createDataFrame(rows, "pdf_url string, ok boolean, at timestamp_ntz")
    got = {r["pdf_url"]: r["next_at"] for r in ingest.retry_schedule(df).collect()}
    assert got == {"a": start + timedelta(seconds=4), "b": start + timedelta(seconds=9), "c": None}
    waits = spark.range(1, 8).select(ingest.retry_wait(F.col("id"))).collect()
    assert [r[0] for r in waits] == [4, 4, 4, 8, 10, 10, 10]


def test_fetches(spark, rows):
    log = spark.createDataFrame([("u1", 200, bytearray(b"x")), ("u2", 403, None), ("u3", 404, None), ("u4", None, None)], "pdf_url string, status int, content binary")
    accepted = ingest.accepted_fetches(log).first()
    assert accepted["size"] == 1 and accepted["sha256"].startswith("2d711642b726b044")
    assert rows(ingest.rejected_fetches(log)) == [("download", "u2", "HTTP 403"), ("download", "u3", "HTTP 404"), ("download", "u4", "HTTP ?")]
