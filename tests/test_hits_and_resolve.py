import json

from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators import dedupe, hits, resolve, stats
from quillmill.operators.hits import Provider
from quillmill.sources.hits import read_hits
from quillmill.sources import hits as hit_files

HIT = schemas.HIT + ", ord bigint"


def hit(spark, *values):
    return spark.createDataFrame(list(values), HIT)


def test_topic_expansion_is_distinct_and_whole(spark, rows):
    topics = spark.createDataFrame([("Creatine",), ("",)], "topic string")
    assert rows(hits.topic_to_queries(topics)) == [(0, "", ""), (0, "Creatine", "Creatine")]
    many = lambda t: [F.concat(t, F.lit(str(i % 15))) for i in range(40)]
    got = hits.topic_to_queries(topics.limit(1), many).collect()
    assert [r["query"] for r in got] == [f"Creatine{i}" for i in range(15)]
    first = hits.topic_to_queries(topics.limit(1), many, max_variants=3).collect()
    assert [r["query"] for r in first] == ["Creatine0", "Creatine1", "Creatine2"]


def test_defaults_of_missing_and_null_fields(spark, rows):
    df = spark.createDataFrame([("t", None)], "title string, doi string")
    assert rows(hits.coerce_hits(df)) == [("t", "", "", 0, "unknown", 0.0)]


def test_merge_keeps_the_first_of_each_doi_case_sensitively(spark):
    df = hit(
        spark,
        ("late", "10.1/a", "u2", 2001, "s", 0.9, 5), ("first", "10.1/a", "u1", None, "s", 0.1, 1),
        ("other case", "10.1/A", "u3", 2002, "s", 0.5, 3), ("none", None, "u4", 2003, "s", 0.5, 0), ("blank", "", "u5", 2004, "s", 0.5, 2),
    )
    merged = dedupe.merge_hits(df).orderBy("ord")
    assert [(r["title"], r["year"]) for r in merged.collect()] == [("first", None), ("other case", 2002)]
    assert dedupe.merge_hits(merged).orderBy("ord").collect() == merged.collect()


def test_search_matches_all_words_and_survives_a_broken_provider(spark):
    first = spark.createDataFrame(
        [("Creatine and exercise", "10.1/a", "u", 2020, "p1", 0.8, 0), ("Exercise", "10.1/b", "u", 2020, "p1", 0.8, 1)],
        schemas.HIT + ", hit_idx bigint",
    )
    second = spark.createDataFrame([("EXERCISE: creatine!", "10.1/a", "v", 2021, "p2", 0.8, 0)], schemas.HIT + ", hit_idx bigint")
    providers = [
        Provider("one", lambda s: first),
        Provider("broken", lambda s: s.read.parquet("/nonexistent/dump")),
        Provider("two", lambda s: second),
    ]
    queries = spark.createDataFrame([(0, "creatine exercise"), (1, "exercise")], "query_idx int, query string")
    found = hits.search(spark, queries, providers)
    got = sorted((r["ord"]["query_idx"], r["ord"]["source_idx"], r["ord"]["hit_idx"], r["doi"]) for r in found.collect())
    assert got == [(0, 0, 0, "10.1/a"), (0, 2, 0, "10.1/a"), (1, 0, 0, "10.1/a"), (1, 0, 1, "10.1/b"), (1, 2, 0, "10.1/a")]
    merged = hits.search_and_merge(spark, queries, providers)
    assert sorted((r["doi"], r["source"]) for r in merged.collect()) == [("10.1/a", "p1"), ("10.1/b", "p1")]
    many = spark.range(3000).selectExpr(
        "concat('u', id) AS url", "named_struct('query_idx', cast(id * 7 % 2500 AS int), 'source_idx', cast(id % 3 AS int), 'hit_idx', id) AS ord")
    in_order = many.join(hits.numbered(many, "url"), "url").orderBy("n").collect()
    assert [tuple(r["ord"]) for r in in_order] == sorted(tuple(r["ord"]) for r in in_order)
    assert len({r["n"] for r in in_order}) == 3000


def test_broken_json_is_told(spark, tmp_path, rows):
    (tmp_path / "lines.json").write_text('{"title": "a", "year": 1}\n{"title": "b"\n{"title": "c", "year": "x"}\n{"title": "d"}\n')
    read, rejects = read_hits(spark, str(tmp_path / "lines.json"), multi_line=False)
    assert [r["title"] for r in read.orderBy("title").collect()] == ["a", "d"]
    assert sorted((r["stage"], r["reason"], r["record"]) for r in rejects.collect()) == [
        ("read", "broken_json", '{"title": "b"'), ("read", "broken_json", '{"title": "c", "year": "x"}')]
    (tmp_path / "arrays").mkdir()
    (tmp_path / "arrays" / "good.json").write_text('[{"title": "a"},\n {"title": "b"}]')
    (tmp_path / "arrays" / "short.json").write_text('[{"title": "c"},\n {"title": ')
    read, rejects = read_hits(spark, str(tmp_path / "arrays"))
    assert [r["title"] for r in read.orderBy("title").collect()] == ["a", "b"]
    assert [r["key"].split("/")[-1] for r in rejects.collect()] == ["short.json"]


def test_title_merge_ignores_case_marks_and_word_order(spark):
    df = hit(
        spark, ("The Effects of X", "a", "u", 1, "s", 0.0, 1), ("effects of x, THE", "b", "u", 1, "s", 0.0, 0),
        ("Other", "c", "u", 1, "s", 0.0, 2), ("?!", "d", "u", 1, "s", 0.0, 3), (None, "e", "u", 1, "s", 0.0, 4),
    )
    assert sorted(r["doi"] for r in dedupe.merge_by_title(df).collect()) == ["b", "c", "d", "e"]


CASES = [
    # doi, url -> pdf_url, tag
    ("10.1/x", "http://h/x.pdf", ("http://h/x.pdf", "src")),
    ("10.1/x", "http://h/x.PDF", None),
    ("10.1/x", "http://h/x.pdf?a=1", None),
    ("10.48550/arXiv.2301.00001", "u", ("https://arxiv.org/pdf/2301.00001.pdf", "arxiv")),
    ("10.48550/arXiv.arxiv.1", "u", ("https://arxiv.org/pdf/arxiv.1.pdf", "arxiv")),
    ("10.2/OA", "u", ("https://oa/1.pdf", "unpaywall")),
    ("10.2/empty", "u", ("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC7/pdf", "pmc")),
    ("10.2/nolocation", "u", None),
    ("10.3/firstnull", "u", None),
    ("10.1145/ABC", "u", ("https://dl.acm.org/doi/pdf/10.1145/abc", "acm")),
    ("10.20944/preprints1", "http://p/manuscript/1/v1//", ("http://p/manuscript/1/v1/download/pdf", "preprints")),
    ("10.20944/preprints1", "http://p/other", None),
    ("10.20944/preprints1", None, None),
    ("10.31219/osf.io/ab_v1c_v1", "u", ("https://osf.io/abc/download", "osf")),
    ("10.22541/au.1", "u", ("https://www.authorea.com/doi/pdf/10.22541/au.1", "authorea")),
    (None, "u", None),
    ("", "u", None),
    (None, "http://h/y.pdf", ("http://h/y.pdf", "src")),
]


def snapshots(spark):
    oa = spark.createDataFrame(
        [("10.2/oa", ("https://oa/1.pdf",)), ("10.2/empty", ("",)), ("10.2/nolocation", None)], schemas.OA_SNAPSHOT
    )
    pmc = spark.createDataFrame(
        [("10.2/Empty", 1, "PMC7"), ("10.2/empty", 2, "PMC8"), ("10.3/firstnull", 1, None), ("10.3/firstnull", 2, "PMC9")],
        schemas.PMC_SNAPSHOT,
    )
    return oa, pmc


def test_resolver_chain(spark, rows):
    df = hit(spark, *[("t", doi, url, 2000, "src", 0.0, i) for i, (doi, url, _) in enumerate(CASES)])
    for salts in (1, 5):
        got = resolve.resolve(df, *snapshots(spark), salts=salts).orderBy("ord").collect()
        assert [(r["pdf_url"], r["resolver_source"]) if r["pdf_url"] else None for r in got] == [c[2] for c in CASES]
    rate = stats.resolution_rate(resolve.resolve(df, *snapshots(spark))).first()
    found = sum(c[2] is not None for c in CASES)
    assert (rate["total"], rate["resolved"]) == (len(CASES), found)
    assert abs(rate["success_rate"] - 100 * found / len(CASES)) < 1e-9
    assert stats.resolution_rate(resolve.resolve(df.limit(0), *snapshots(spark))).first()["success_rate"] is None
    assert resolve.keep_unresolved(resolve.resolve(df, *snapshots(spark))).count() == len(CASES) - found


def test_rules_can_be_replaced_and_reordered(spark):
    mine = resolve.Rule("mine", lambda: F.when(F.col("title") == "t", F.lit("http://mine")), lambda: F.lit("me"))
    df = hit(spark, ("t", None, "http://h/y.pdf", 1, "s", 0.0, 0), ("z", None, "http://h/y.pdf", 1, "s", 0.0, 1))
    got = resolve.resolve(df, *snapshots(spark), rules=[mine, *resolve.DEFAULT_RULES]).orderBy("ord").collect()
    assert [r["resolver_source"] for r in got] == ["me", "s"]
    got = resolve.resolve(df, *snapshots(spark), rules=[mine]).orderBy("ord").collect()
    assert [r["resolver_source"] for r in got] == ["me", None]


def test_later_rules_see_hits_without_a_doi(spark):
    last = resolve.Rule("last", lambda: F.when(F.col("oa_pdf_url").isNull(), F.concat(F.lit("http://last/"), F.col("title"))), lambda: F.lit("last"), local=False)
    df = hit(spark, ("t", None, "u", 1, "s", 0.0, 0), ("v", "", "u", 1, "s", 0.0, 1), ("w", "10.9/none", "u", 1, "s", 0.0, 2))
    got = resolve.resolve(df, *snapshots(spark), rules=[*resolve.DEFAULT_RULES, last]).orderBy("ord").collect()
    assert [r["pdf_url"] for r in got] == ["http://last/t", "http://last/v", "http://last/w"]


def test_fetch_plan(spark):
    df = spark.createDataFrame(
        [("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf", "pmc"), ("http://h/x.pdf", "s"), (None, None)],
        "pdf_url string, resolver_source string",
    )
    plan = resolve.fetch_plan(df).orderBy("pdf_url", "try_no").collect()
    assert [r["request_url"] for r in plan] == [
        "http://h/x.pdf",
        "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf/",
        "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf",
    ]


def test_fetch_plan_has_the_headers_of_each_request(spark):
    pmc = "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1/pdf"
    df = spark.createDataFrame([(pmc, "pmc"), ("http://h/x.pdf", "s")], "pdf_url string, resolver_source string")
    plan = resolve.fetch_plan(df).orderBy("pdf_url", "try_no").collect()
    assert [len(r["headers"]) for r in plan] == [11, 13, 13]
    assert "Referer" not in plan[0]["headers"] and plan[1]["headers"]["DNT"] == "1"
    assert {r["headers"]["Referer"] for r in plan[1:]} == {"https://www.ncbi.nlm.nih.gov/"}


def test_url_and_content_dedupe(spark, rows):
    df = spark.createDataFrame([("u1", 3), ("u1", 1), ("u2", 2), (None, 4)], "pdf_url string, ord bigint")
    assert rows(dedupe.unique_by_url(df.filter("pdf_url is not null"))) == [("u1", 1), ("u2", 2)]
    done = spark.createDataFrame([("u1",)], "pdf_url string")
    assert rows(dedupe.drop_processed(df.filter("pdf_url is not null"), done)) == [("u2", 2)]
    bodies = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None)], "id bigint, body string")
    kept, rejects = dedupe.split_by_content(bodies, F.col("body"), "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 4, 5]
    assert [(r["id"], r["reason"]) for r in rejects.collect()] == [(2, "duplicate_sha256")]


def test_json_sources_and_sinks(spark, tmp_path):
    records = [{"title": "A", "doi": "10.1/a", "url": "u", "year": 2020, "source": "s", "score": 0.8}, {"title": "B", "year": None}]
    (tmp_path / "in.json").write_text(json.dumps(records))
    read = hit_files.read_hits_json(spark, str(tmp_path / "in.json"))
    assert [tuple(r) for r in read.orderBy("title").collect()] == [("A", "10.1/a", "u", 2020, "s", 0.8), ("B", "", "", 0, "unknown", 0.0)]
    hit_files.write_hits_json(read, str(tmp_path / "out"))
    again = hit_files.read_hits_json(spark, str(tmp_path / "out"), multi_line=False)
    assert sorted(again.collect()) == sorted(read.collect())
    ranked = spark.createDataFrame([("A", 1.5)], "sentence string, score double")
    hit_files.write_ranked_json(ranked, str(tmp_path / "ranked"))
    assert spark.read.json(str(tmp_path / "ranked")).first().asDict() == {"sentence": "A", "score": "1.5"}
    resolved = read.withColumn("pdf_url", F.lit("p")).withColumn("resolver_source", F.lit(None).cast("string"))
    hit_files.write_resolved_json(resolved, str(tmp_path / "resolved"))
    fields = json.loads(spark.read.text(str(tmp_path / "resolved")).first()[0])
    assert list(fields) == schemas.RESOLVED_COLUMNS
