import random
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators import ingest, stats, vector_search
from quillmill.operators.hits import Provider
from quillmill.plans import literature
from quillmill.streaming import fetches, jobs



def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def land(spark, folder, rows):
    df = spark.createDataFrame(rows, jobs.LANDING)
    df.coalesce(1).write.mode("append").parquet(str(folder))


def row(i, doi=None, url=None, status=200, body=None):
    text = f"Paper {i}. " + "word " * 60 if body is None else body
    return (doi or f"10.1/{i}", f"T{i}", 2024, "src", url or f"http://h/{i}.pdf", status, bytearray(text.encode()), i)


def flow(tmp_path, spark):
    made = jobs.IngestFlow(str(tmp_path / f"store-{uuid.uuid4().hex}"), buckets=4, as_of=as_of(), embedder=vector_search.hash_embedder(16))
    made.create(spark)
    return made


BATCHES = [
    [row(1), row(2, status=403), row(3, body="  \n "), row(4, url="http://h/1.pdf"), row(9, body="... !")],
    [row(5, body="Paper 1. " + "word " * 60), row(6), row(7, doi="10.1/6"), row(8, url="http://h/6.pdf"), row(10, url="http://h/2.pdf", doi="10.1/2")],
]


def check(spark, f):
    papers = {r["doi"]: (r["id"], r["title"]) for r in f.table(spark, "papers").collect()}
    # the URL that failed first is stored by its second attempt
    assert papers == {"10.1/1": (1, "T1"), "10.1/6": (2, "T7"), "10.1/2": (3, "T10")}
    assert f.table(spark, "summaries").count() == 12
    assert sorted(r["embedding_type"] for r in f.table(spark, "embeddings").collect()) == ["abstract"] * 3 + ["full_text"] * 3 + ["title"] * 3
    found = {(r["key"], r["value"]) for r in f.table(spark, "paper_metadata").collect()}
    assert found == {("keywords", '["paper"]')}
    failed = {(r["stage"], r["key"], r["reason"]) for r in f.stage_log(spark).filter("not ok").collect()}
    assert failed == {("download", "http://h/2.pdf", "HTTP 403"), ("parse", "http://h/3.pdf", "empty_text"),
                      ("store", "http://h/5.pdf", "duplicate_sha256"), ("summarise", "http://h/9.pdf", "summary_failed")}


def test_flow_over_two_runs_and_a_repeated_batch(spark, tmp_path):
    f = flow(tmp_path, spark)
    for batch in BATCHES:
        land(spark, tmp_path / "landing", batch)
        stream = jobs.landing_stream(spark, str(tmp_path / "landing"), jobs.LANDING, max_files=1)
        f.start(stream, str(tmp_path / "progress")).awaitTermination()
    check(spark, f)
    dashboard = {r["stage"]: (r["items"], r["succeeded"]) for r in stats.stage_dashboard(f.stage_log(spark)).collect()}
    assert dashboard == {"download": (8, 7), "parse": (7, 6), "summarise": (4, 3), "embed": (4, 4), "store": (4, 3)}
    # a batch that runs again changes nothing
    seen_before = [r for r in BATCHES[1] if r[4] != "http://h/8.pdf" and r[4] != "http://h/6.pdf"] + [BATCHES[1][1]]
    f.store_batch(spark.createDataFrame(seen_before, jobs.LANDING), 1)
    check(spark, f)


def test_a_batch_that_dies_leaves_the_tables(spark, tmp_path):
    f = flow(tmp_path, spark)
    f.store_batch(spark.createDataFrame([row(1)], jobs.LANDING), 0)
    broken = jobs.IngestFlow(f.folder, buckets=4, as_of=as_of(), embedder=vector_search.hash_embedder(16),
                             describe=lambda df, text, key: df.select(key, F.raise_error(F.lit("model is gone")).alias("metadata")))
    try:
        broken.store_batch(spark.createDataFrame([row(2), row(3, doi="10.1/1")], jobs.LANDING), 1)
        raise AssertionError("it should have failed")
    except AssertionError:
        raise
    except Exception:
        pass
    assert [(r["doi"], r["title"]) for r in f.table(spark, "papers").collect()] == [("10.1/1", "T1")]
    assert f.table(spark, "summaries").count() == 4
    f.store_batch(spark.createDataFrame([row(2), row(3, doi="10.1/1")], jobs.LANDING), 1)
    assert sorted((r["doi"], r["title"]) for r in f.table(spark, "papers").collect()) == [("10.1/1", "T3"), ("10.1/2", "T2")]


ATTEMPTS = "pdf_url string, status int, ord bigint, content binary, at timestamp"


def attempts(*rows):
    start = datetime(2024, 1, 1)
    return [(u, s, o, bytearray(b"body"), start + timedelta(seconds=sec)) for u, s, o, sec in rows]


def outcomes(spark, tmp_path, name, **options):
    found = []
    stream = jobs.landing_stream(spark, str(tmp_path / "in"), ATTEMPTS, max_files=1)
    told = fetches.fetch_outcomes(stream, **options).writeStream.option("checkpointLocation", str(tmp_path / name)).outputMode("append")
    keep = lambda b, _: found.extend((r["pdf_url"], r["outcome"], r["attempts"], r["ord"], r["next_at"]) for r in b.collect())
    told.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    return sorted(found, key=repr)


def test_outcomes_of_urls(spark, tmp_path):
    def put(*rows):
        spark.createDataFrame(attempts(*rows), ATTEMPTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    at = lambda sec: datetime(2024, 1, 1) + timedelta(seconds=sec)
    put(("a", 403, 1, 0), ("b", 200, 5, 1), ("b", 200, 3, 2), ("c", 500, 1, 0), ("c", 500, 2, 0), ("c", None, 3, 0), ("c", 200, 4, 0))
    first = [("a", "retry", 1, 1, at(4)), ("b", "accepted", 0, 3, None), ("c", "rejected", 3, 3, None)]
    assert outcomes(spark, tmp_path, "plain") == first
    # the state lives on in the progress folder: what is done stays done, and the failed URL is accepted
    put(("a", 200, 9, 30), ("b", 200, 1, 31), ("c", 200, 9, 33), ("d", 403, 1, 100), ("d", 403, 2, 101))
    second = [("a", "accepted", 1, 9, None), ("d", "retry", 2, 2, at(105))]
    assert outcomes(spark, tmp_path, "plain") == second
    # with event time a retry that nobody made is told as due, and done URLs are forgotten
    put(("e", 200, 1, 5000), ("b", 200, 6, 5001))
    put(("b", 200, 7, 90_000))
    timed = outcomes(spark, tmp_path, "timed", event_time=True, forget=600.0)
    due = [o for o in timed if o[1] == "due"]
    assert due == [("d", "due", 2, None, at(105))]
    assert [o for o in timed if o[0] == "b"] == [("b", "accepted", 0, 3, None), ("b", "accepted", 0, 7, None)]


def test_a_hot_url_is_read_once(spark, tmp_path):
    """One URL with most of the rows, in many Arrow batches: the first success by number, few failures before it."""
    rows = spark.range(40_000).selectExpr(
        "'hot' AS pdf_url", "CASE WHEN id IN (3, 7) THEN 404 ELSE 200 END AS status", "40000 - id AS ord", "CAST('x' AS binary) AS content",
        "timestamp'2024-01-01 00:00:00' AS at")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = jobs.landing_stream(spark, str(tmp_path / "in"), ATTEMPTS)
    told = fetches.fetch_outcomes(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "p"))
    told.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    found = spark.read.schema(f"{ATTEMPTS}, {fetches.OUTCOME}").parquet(str(tmp_path / "out")).collect()
    assert [(r["outcome"], r["ord"], r["attempts"]) for r in found] == [("accepted", 1, 0)]


class OneUrl:
    """The state of one URL, as the handle and the value state of a task."""

    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_url_is_judged_from_plain_rows():
    """No data frame for each URL: with millions of URLs a batch's time was that of making them."""
    attempt = Row("pdf_url", "status", "ord", "at")
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    url, state = fetches.UrlProgress(["pdf_url", "status", "ord", "at"], False, 60.0), OneUrl()
    url.init(state)
    judged = lambda *rows: [(r.outcome, r.attempts, r.ord, r.next_at) for r in url.handleInputRows(("u",), iter(rows), None)]
    assert judged(attempt("u", 404, None, start), attempt("u", 403, 7, None)) == [("retry", 2, None, start + timedelta(seconds=4))]
    assert state.value == (False, 2, 1704067204000)
    assert judged(attempt("u", 200, 9, start), attempt("u", None, 8, start), attempt("u", 200, 3, start)) == [("accepted", 2, 3, None)]
    assert judged(attempt("u", 200, 1, start)) == [] and state.value == (True, 2, None)


class OnePage(OneUrl):
    """Counts how often its state is read and written."""

    def __init__(self):
        super().__init__()
        self.reads = self.writes = 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.writes += 1
        self.value = value


def test_urls_of_a_page_share_their_messages():
    """Reading and writing the state costs far more than the work on a URL: a page does it once a batch, with the outcomes of its URLs."""
    draw, start = random.Random(4), datetime(2024, 1, 1, tzinfo=timezone.utc)
    attempt, columns = Row("pdf_url", "status", "ord", "at", "_page"), ["pdf_url", "status", "ord", "at"]
    page, kept = fetches.PageProgress(columns), OnePage()
    page.init(kept)
    names = [None, "null", "None", "", "é\n\"[", *(f"u{k}" for k in range(60))]
    urls = {name: (fetches.UrlProgress(columns, False, 60.0), OneUrl()) for name in names}
    for url, state in urls.values():
        url.init(state)
    told = 0
    for batch in range(5):
        rows = []
        for name in names:
            for _ in range(draw.choice([0, 1, 1, 2, 6])):
                at = draw.choice([None, start + timedelta(seconds=draw.randint(0, 99))])
                rows.append(attempt(name, draw.choice([200, 403, 404, None]), draw.choice([None, *range(9)]), at, 0))
        draw.shuffle(rows)
        got = sorted(map(tuple, page.handleInputRows((0,), iter(rows), None)), key=repr)
        of = {name: [Row(*columns)(*r[:4]) for r in rows if r["pdf_url"] == name] for name in names}
        want = [tuple(r) for name, (url, _) in urls.items() if of[name] for r in url.handleInputRows((name,), iter(of[name]), None)]
        assert got == sorted(want, key=repr)
        told += len(got)
        assert kept.reads == batch + 1 and kept.writes <= batch + 1  # once all are done there is nothing to write
    assert told > 60


def test_unique_stream_remembers_across_runs(spark, tmp_path):
    for i in range(2):
        land(spark, tmp_path / "landing", [row(1), row(i + 10), row(i + 10)])
        stream = jobs.landing_stream(spark, str(tmp_path / "landing"), jobs.LANDING).select("pdf_url")
        jobs.append_unique(stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    urls = [r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(urls) == ["http://h/1.pdf", "http://h/10.pdf", "http://h/11.pdf"]


def test_unique_within_watermark(spark, tmp_path):
    df = spark.sql("SELECT 'u' AS pdf_url, timestamp'2024-01-01 00:00:00' AS at UNION ALL SELECT 'u', timestamp'2024-01-01 01:00:00'")
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.landing_stream(spark, str(tmp_path / "in"), "pdf_url string, at timestamp")
    jobs.append_unique(stream, str(tmp_path / "out"), str(tmp_path / "progress"), event_time="at", delay="1 day").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_status_stream_equals_the_batch_fold(spark, tmp_path, rows):
    schema = "ingest_id bigint, ord bigint, status string, error string"
    events = [(i % 3, i, f"s{i}", f"e{i}" if i % 4 == 0 else None) for i in range(20)]
    for part in (events[:9], events[9:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.landing_stream(spark, str(tmp_path / "in"), schema, max_files=1)
    jobs.status_stream(stream, str(tmp_path / "state"), str(tmp_path / "progress"), buckets=2).awaitTermination()
    from quillmill.sources.tables import read_table

    state = read_table(spark, str(tmp_path / "state"), jobs.STATUS_STATE)
    assert rows(state) == rows(ingest.fold_status_events(spark.createDataFrame(events, schema)))


def test_file_store_stream(spark, tmp_path):
    land(spark, tmp_path / "landing", [row(1), row(2, body="same"), row(3, body="same"), row(4, status=404)])
    stream = jobs.landing_stream(spark, str(tmp_path / "landing"), jobs.LANDING)
    jobs.store_files(stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_topic_to_stored_papers(spark, tmp_path):
    dump = spark.createDataFrame(
        [
            ("Creatine for exercise", "10.48550/arXiv.1", "u", 2020, "p", 0.8, 0),
            ("Exercise: creatine, for all", "10.2/oa", "u", 2021, "p", 0.8, 1),
            ("Creatine for exercise again", "10.9/none", "u", 2021, "p", 0.8, 2),
            ("Other", "10.1145/x", "u", 2021, "p", 0.8, 3),
            ("For creatine, exercise", "10.3/pmc", "u", 2022, "p", 0.8, 4),
        ],
        schemas.HIT + ", hit_idx bigint",
    )
    oa = spark.createDataFrame([("10.2/oa", ("https://oa/1.pdf",))], schemas.OA_SNAPSHOT)
    pmc = spark.createDataFrame([("10.3/pmc", 1, "PMC1")], schemas.PMC_SNAPSHOT)
    fetches = [
        ("https://arxiv.org/pdf/1.pdf", 1, 404, None), ("https://arxiv.org/pdf/1.pdf", 2, 200, bytearray(b"Arxiv text.")),
        ("https://oa/1.pdf", 1, 403, None),
        ("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf/", 1, 200, bytearray(b"Pmc text.")),
        ("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf", 1, 404, None),
    ]
    log = spark.createDataFrame(fetches, "pdf_url string, attempt int, status int, content binary")
    f = flow(tmp_path, spark)
    topics = spark.createDataFrame([("creatine for exercise",)], "topic string")
    literature.run(spark, topics, [Provider("p", lambda s: dump)], oa, pmc, log, f)
    got = {r["doi"]: (r["source"], r["pdf_url"]) for r in f.table(spark, "papers").collect()}
    assert got == {
        "10.48550/arXiv.1": ("arxiv", "https://arxiv.org/pdf/1.pdf"),
        "10.3/pmc": ("pmc", "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf"),
    }
    assert {(r["stage"], r["reason"]) for r in f.stage_log(spark).filter("not ok").collect()} == {("download", "HTTP 403")}


def test_stream_queries_read_tables_of_part_files_and_single_files(spark, tmp_path, rows):
    from pathlib import Path

    from quillmill.plans import catalog
    from quillmill.plans.inputs import Inputs

    events = spark.range(40).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "timestamp'2024-01-01 00:00:00' AS ts",
        "if(id % 4 = 0, 'error', 'view') AS event_type", "concat('{\"k\": ', id % 10, '}') AS props",
    )
    pages = spark.range(6).selectExpr(
        "id AS page_id", "concat('http://h/', id) AS url", "concat('<html><title>T', id, '</title>', repeat('word ', 60), id, '</html>') AS html"
    )
    found = {}
    for form, parts in (("one", 1), ("many", 3)):
        for name, df in (("events", events), ("pages", pages)):
            df.repartition(parts).write.parquet(str(tmp_path / form / f"{name}.parquet"))
    for name in ("events", "pages"):
        (part,) = Path(tmp_path / "one" / f"{name}.parquet").glob("part-*.parquet")
        (tmp_path / "file").mkdir(exist_ok=True)
        (tmp_path / "file" / f"{name}.parquet").write_bytes(part.read_bytes())
    for form in ("many", "file"):
        i = Inputs(spark, str(tmp_path / form))
        found[form] = [rows(q(i)) for q in (catalog.stream_unique_urls, catalog.stream_status, catalog.stream_ingest_papers)]
    assert [len(r) for r in found["many"]] == [15, 7, 6]
    assert found["file"] == found["many"]
