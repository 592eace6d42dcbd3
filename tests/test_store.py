import pytest
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators import constraints, dedupe, lookups, store
from quillmill.operators.running import assign_ids, running_total
from quillmill.plans import catalog
from quillmill.plans.inputs import Inputs
from quillmill.sources import files, seed, tables

PAPERS = schemas.PAPERS


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")
OLD = "2024-01-01 00:00:00"


def papers(spark, *rows):
    """Rows of (id, doi, title, sha256)."""
    df = spark.createDataFrame(list(rows), "id bigint, doi string, title string, sha256 string")
    return df.select(
        "id", "doi", "title", F.array(F.lit("author")).alias("authors"), F.lit(1999).alias("year"), F.lit("url").alias("pdf_url"),
        F.lit("path").alias("file_path"), "sha256", F.lit("src").alias("source"),
        F.lit(OLD).cast("timestamp").alias("created_at"), F.lit(OLD).cast("timestamp").alias("updated_at"),
    )


def incoming(spark, *rows):
    """Rows of (doi, title, sha256, ord)."""
    df = spark.createDataFrame(list(rows), "doi string, title string, sha256 string, ord bigint")
    return df.withColumns({"year": F.lit(2024), "pdf_url": F.lit("new"), "source": F.lit(None).cast("string")})


def test_running_total_equals_a_window(spark):
    rows = [(k, o, (o * 7) % 5) for k in (1, 2, None) for o in range(0, 50, 3)]
    df = spark.createDataFrame(rows, "k int, o bigint, v int")
    got = {(r["k"], r["o"]): r["t"] for r in running_total(df, F.col("v"), "o", "t", by=("k",), width=8).collect()}
    assert got == {(k, o): sum(v for kk, oo, v in rows if kk == k and oo < o) for k, o, _ in rows}


def test_ids_are_serial_in_arrival_order(spark):
    df = spark.createDataFrame([(o // 2, str(o)) for o in range(100)], "o bigint, name string")
    got = assign_ids(df, "o", "id", 10, ties=["name"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(11, 111))
    assert [(r["o"], r["name"]) for r in got] == sorted((o // 2, str(o)) for o in range(100))


def test_ids_of_sparse_and_tied_orders(spark):
    sparse = spark.createDataFrame([(int(o) * 7919 * 10**12 % (2**62), o % 3) for o in range(500)], "o bigint, k int")
    got = assign_ids(sparse, "o", "id", F.lit(0)).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 501)) and [r["o"] for r in got] == sorted(r["o"] for r in got)
    tied = spark.createDataFrame([("one", k) for k in range(300)], "o string, k int").repartition(6)
    got = assign_ids(tied, "o", "id", 5, ties=["k"]).orderBy("id").collect()
    assert [(r["k"], r["id"]) for r in got] == [(k, k + 6) for k in range(300)]
    assert assign_ids(tied.limit(0), "o", "id").collect() == []


def test_edges_that_come_very_often(spark, rows):
    df = spark.range(3000).selectExpr("id % 2 AS source_paper_id", "id % 3 AS target_paper_id", "'cites' AS relationship_type", "0.5D AS confidence", "3000 - id AS ord")
    edges = spark.createDataFrame([(9, 0, 0, "cites", 0.1, None)], schemas.PAPER_RELATIONSHIPS)
    after, conflicts = store.insert_edges(edges, df, now())
    assert after.count() == 6 and conflicts.count() == 3000 - 5
    assert sorted(r["id"] for r in after.collect()) == [9, 10, 11, 12, 13, 14]


def test_upsert_overwrites_inserts_and_keeps(spark):
    have = papers(spark, (1, "10.1/a", "A", "h1"), (2, "10.1/b", "B", "h2"), (5, None, "N", "h5"))
    new = incoming(spark, ("10.1/b", "first", "x", 1), ("10.1/b", None, "y", 2), ("10.1/c", "C", "z", 3), (None, "M", "q", 4), (None, "M2", "r", 5))
    after = store.upsert_papers(have, new, now())
    assert after.columns == have.columns
    got = {r["id"]: r for r in after.collect()}
    assert sorted(got) == [1, 2, 5, 6, 7, 8]
    assert got[1]["title"] == "A" and str(got[1]["updated_at"]) == OLD
    # the last row of the batch wins, and its NULLs overwrite
    assert got[2]["title"] is None and got[2]["sha256"] == "y" and got[2]["source"] is None and got[2]["authors"] == ["author"]
    assert str(got[2]["created_at"]) == OLD and str(got[2]["updated_at"]) == "2024-06-01 00:00:00"
    assert got[6]["doi"] == "10.1/c" and got[6]["authors"] is None and [got[7]["title"], got[8]["title"]] == ["M", "M2"]
    keyed = new.filter("doi is not null")
    once = store.upsert_papers(have, keyed, now())
    twice = store.upsert_papers(once, keyed, now())
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_upsert_into_an_empty_table(spark):
    after = store.upsert_papers(spark.createDataFrame([], PAPERS), incoming(spark, ("d", "T", "h", 9)), now())
    assert [(r["id"], r["doi"]) for r in after.collect()] == [(1, "d")]


def test_children_follow_their_paper(spark):
    have = papers(spark, (1, "10.1/a", "A", "h1"), (2, "10.1/b", "B", "h2"))
    empty = spark.createDataFrame([], schemas.SUMMARIES)
    new = spark.createDataFrame(
        [("10.1/a", "executive", "old", 1), ("10.1/a", "executive", "new", 2), ("10.1/x", "executive", "lost", 3), ("10.1/b", "methodology", "m", 4)],
        "doi string, summary_type string, content string, ord bigint",
    )
    after = store.upsert_summaries(empty, new, have, now())
    assert sorted((r["id"], r["paper_id"], r["content"]) for r in after.collect()) == [(1, 1, "new"), (2, 2, "m")]
    vectors = new.select("doi", F.col("summary_type").alias("embedding_type"), F.array(F.lit(1.0).cast("float")).alias("embedding"), "ord")
    after = store.upsert_embeddings(spark.createDataFrame([], schemas.EMBEDDINGS), vectors, have, now())
    assert sorted((r["paper_id"], r["embedding"][0]) for r in after.collect()) == [(1, 1.0), (2, 1.0)]


def test_insert_if_absent_never_changes_a_row(spark):
    have = papers(spark, (1, "10.1/a", "A", "h1"))
    new = incoming(spark, ("10.1/a", "changed", "x", 1), ("10.1/b", "B1", "y", 2), ("10.1/b", "B2", "z", 3))
    got = sorted((r["id"], r["title"]) for r in store.insert_if_absent(have, new, ["doi"], now()).collect())
    assert got == [(1, "A"), (2, "B1")]


def test_edges_conflict_instead_of_overwriting(spark, rows):
    edges = spark.createDataFrame([(1, 1, 2, "cites", 0.9, None)], schemas.PAPER_RELATIONSHIPS)
    new = spark.createDataFrame(
        [(1, 2, "cites", 0.1, 1), (2, 1, "cites", 0.2, 2), (2, 1, "cites", 0.3, 3), (1, 2, "related_to", 0.4, 4)],
        "source_paper_id bigint, target_paper_id bigint, relationship_type string, confidence double, ord bigint",
    )
    after, conflicts = store.insert_edges(edges, new, now())
    assert sorted((r["id"], r["confidence"]) for r in after.collect()) == [(1, 0.9), (2, 0.2), (3, 0.4)]
    assert sorted(r["confidence"] for r in conflicts.collect()) == [0.1, 0.3]


def test_create_with_defaults(spark):
    queue = spark.createDataFrame([], schemas.INGEST_QUEUE)
    new = spark.createDataFrame([(1, "f", None)], "ingest_id bigint, file_id string, status string")
    row = store.create_rows(queue, new, {"status": F.lit("pending"), "retries": F.lit(0), "updated_at": now()}).first()
    assert (row["status"], row["retries"], row["last_error"]) == ("pending", 0, None)


def test_patch_tells_null_from_unset(spark, rows):
    have = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id bigint, t string, u string")
    patches = spark.createDataFrame(
        [(1, ["t"], None, "ignored", 1), (2, ["u"], "ignored", "first", 1), (2, ["u", "t"], "T", "last", 2), (2, ["t"], "T3", None, 3)],
        "id bigint, fields array<string>, t string, u string, ord bigint",
    )
    assert rows(store.patch_rows(have, patches, "id", ["t", "u"], order="ord")) == [(1, None, "x"), (2, "T3", "last"), (3, "c", "z")]
    single = patches.filter("id = 1")
    assert rows(store.patch_rows(have, single, "id", ["t", "u"])) == [(1, None, "x"), (2, "b", "y"), (3, "c", "z")]


def test_delete_reports_what_existed(spark, rows):
    have = spark.createDataFrame([(1,), (2,)], "id bigint")
    ids = spark.createDataFrame([(2,), (7,), (2,)], "id bigint")
    left, report = store.delete_rows(have, ids, "id")
    assert rows(left) == [(1,)] and rows(report) == [(2, True), (7, False)]


def test_cascade_over_two_levels_and_both_ends_of_edges(spark, rows):
    t = {
        "works": spark.createDataFrame([("w1",), ("w2",)], "work_id string"),
        "files": spark.createDataFrame([("f1", "w1"), ("f2", "w2")], "file_id string, work_id string"),
        "chunks": spark.createDataFrame([("c1", "f1"), ("c2", "f2"), ("c3", "f1")], "chunk_id string, file_id string"),
        "file_summaries": spark.createDataFrame([("s2", "f2")], "summary_id string, file_id string"),
        "ingest_queue": spark.createDataFrame([(1, "f1")], "ingest_id bigint, file_id string"),
    }
    ids = spark.createDataFrame([("w1",), ("unknown",)], "work_id string")
    left = store.cascade_delete(t, "works", "work_id", ids, store.WORK_CHILDREN)
    assert {k: [r[0] for r in v.collect()] for k, v in left.items()} == {
        "works": ["w2"], "files": ["f2"], "chunks": ["c2"], "file_summaries": ["s2"], "ingest_queue": []
    }
    sample = seed.sample_tables(spark, 4, now(), dim=4)
    left = store.cascade_delete(sample, "papers", "id", spark.createDataFrame([(2,)], "id bigint"), store.PAPER_CHILDREN)
    assert {k: v.count() for k, v in left.items()} == {
        "papers": 3, "summaries": 9, "embeddings": 9, "paper_metadata": 9, "paper_relationships": 1
    }


def test_saved_hits_share_the_work_id(spark):
    works, found = spark.createDataFrame([], schemas.WORKS), spark.createDataFrame([], schemas.SEARCH_HITS)
    hits = spark.createDataFrame([("10.1/a", "u1", "p", 1), (None, "u2", "p", 2), ("", None, "p", 3)], "doi string, url string, source string, ord bigint")
    works, found = store.save_hits(works, found, hits, "topic", now())
    assert [r["doi"] for r in works.collect()] == ["10.1/a"]
    assert found.count() == 3 and found.join(works, "work_id").count() == 1
    assert found.select("hit_id").distinct().count() == 3 and len(found.first()["hit_id"]) == 36


def test_saved_hits_have_ids_of_their_own_and_one_work_for_a_doi(spark, rows):
    schema = "title string, doi string, url string, source string, ord struct<a:int,b:int>"
    hits = spark.createDataFrame(
        [("t", "10.1/a", "u1", "p", (1, None)), ("t", "10.1/a", "u1", "p", (None, 1)), ("t", "10.1/a", "u1", "p", (1, None)), ("t", "10.1/b", "u", "p", (2, 2)),
         ("x", None, None, "p", (3, 3)), ("x", "", None, "p", (3, 3)), ("x", None, None, "p", (3, 3))], schema)
    works = spark.createDataFrame([("w-old", "10.1/b", None, None, None, None)], schemas.WORKS)
    after, found = store.save_hits(works, spark.createDataFrame([], schemas.SEARCH_HITS), hits, "topic", now())
    assert sorted(r["doi"] for r in after.collect()) == ["10.1/a", "10.1/b"]
    saved = found.collect()
    assert len(saved) == 7 and len({r["hit_id"] for r in saved}) == 7
    assert len({r["work_id"] for r in saved}) == 5 and "w-old" in {r["work_id"] for r in saved}
    again = store.save_hits(works, spark.createDataFrame([], schemas.SEARCH_HITS), hits.repartition(3), "topic", now())[1]
    assert rows(again) == rows(found)


def test_keyed_table_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "papers")
    tables.create_table(spark.createDataFrame([], PAPERS), path, ["doi"], 8)
    assert tables.read_table(spark, path, PAPERS).count() == 0
    edit = lambda old, new: store.upsert_papers(old, new, now(), max_id=0)
    many = incoming(spark, *[(f"10.1/{i}", f"T{i}", f"h{i}", i) for i in range(40)])
    tables.edit_table(spark, path, PAPERS, ["doi"], many, edit, 8)
    assert tables.read_table(spark, path, PAPERS).count() == 40
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "papers").rglob("*.parquet")}
    one = incoming(spark, ("10.1/3", "changed", "h3", 1))
    tables.edit_table(spark, path, PAPERS, ["doi"], one, edit, 8)
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "papers").rglob("*.parquet")}
    changed = {p.split("key_bucket=")[1].split("/")[0] for p in set(before) ^ set(after)}
    assert len(changed) == 1
    stored = tables.read_table(spark, path, PAPERS)
    assert stored.count() == 40 and stored.filter("doi = '10.1/3'").first()["title"] == "changed"


def two_tables(spark, tmp_path, buckets=4):
    made = tables.Store(str(tmp_path / "store"), {"a": tables.Table("k string, v string", ["k"]), "b": tables.Table("id bigint, k string", ["k"], "id")}, buckets)
    made.create(spark)
    return made


def insert(old, new):
    return old.join(new.select("k"), "k", "left_anti").select(*old.columns).unionByName(new)


def test_edits_of_several_tables_count_together(spark, tmp_path, rows):
    s = two_tables(spark, tmp_path)
    first = s.begin(spark)
    first.edit("a", spark.createDataFrame([("x", "1"), ("y", "1")], "k string, v string"), insert)
    first.edit("b", spark.createDataFrame([(7, "x")], "id bigint, k string"), insert)
    assert rows(s.read(spark, "a")) == [] and rows(first.read("a")) == [("x", "1"), ("y", "1")]
    assert first.last_id("b") == 7
    first.commit()
    assert rows(s.read(spark, "a")) == [("x", "1"), ("y", "1")] and rows(s.read(spark, "b")) == [(7, "x")]
    held = s.read(spark, "a")
    # a batch that dies between its tables, here with the second edit, changes nothing
    broken = s.begin(spark)
    broken.edit("a", spark.createDataFrame([("x", "2")], "k string, v string"), insert)
    with pytest.raises(Exception):
        broken.edit("b", spark.createDataFrame([(8, "x")], "id bigint, k string"), lambda old, new: new.select(F.raise_error(F.lit("no")).cast("bigint").alias("id"), "k"))
    assert rows(s.read(spark, "a")) == [("x", "1"), ("y", "1")] and s.begin(spark).last_id("b") == 7
    # of two batches from the same state one counts
    one, two = s.begin(spark), s.begin(spark)
    for batch, value in ((one, "3"), (two, "4")):
        batch.edit("a", spark.createDataFrame([("x", value)], "k string, v string"), insert)
    one.commit()
    with pytest.raises(RuntimeError):
        two.commit()
    assert rows(s.read(spark, "a")) == [("x", "3"), ("y", "1")]
    assert rows(held) == [("x", "1"), ("y", "1")]  # a reader keeps what it began with
    assert s.forget(spark, keep=1) > 0
    assert rows(s.read(spark, "a")) == [("x", "3"), ("y", "1")] and rows(s.read(spark, "b")) == [(7, "x")]


def test_the_last_row_of_a_bucket_can_be_deleted(spark, tmp_path, rows):
    s = two_tables(spark, tmp_path, buckets=64)
    batch = s.begin(spark)
    batch.replace("a", spark.createDataFrame([(k, k) for k in "pqrs"], "k string, v string"))
    batch.commit()
    batch = s.begin(spark)
    store.delete_cascade(batch, "a", "k", spark.createDataFrame([("q",), ("zz",)], "k string"), [store.Child("b", "k", "a", "k")])
    batch.commit()
    assert rows(s.read(spark, "a")) == [(k, k) for k in "prs"]


def test_rows_must_stay_in_the_buckets_that_were_read(spark, tmp_path):
    s = two_tables(spark, tmp_path, buckets=64)
    with pytest.raises(ValueError):
        s.begin(spark).edit("a", spark.createDataFrame([("x", "1")], "k string, v string"), lambda old, new: new.withColumn("k", F.lit("moved")))


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (None, "b")], "id bigint, k string")
    assert rows(constraints.unique_violations(df, ["k"])) == [("a", 2)]
    assert sorted((r["id"] or 0, r["missing"]) for r in constraints.null_violations(df, ["id", "k"]).collect()) == [(0, ["id"]), (3, ["k"]), (4, ["k"])]
    parents = spark.createDataFrame([(1,), (2,)], "pid bigint")
    assert rows(constraints.foreign_key_violations(df, "id", parents, "pid").select("id")) == [(3,), (4,)]
    kinds = spark.createDataFrame([("tl_dr",), ("other",), (None,)], "kind string")
    assert rows(constraints.enum_violations(kinds, "kind", schemas.SUMMARY_KINDS)) == [("other",)]
    sample = seed.sample_tables(spark, 3, now(), dim=4)
    assert {r["violations"] for r in constraints.violation_counts(sample).collect()} == {0}


def test_lookups(spark, rows):
    df = spark.createDataFrame([(i, "pending" if i % 2 else "done") for i in range(10)], "ingest_id bigint, status string")
    assert rows(lookups.by_key(df, ingest_id=3)) == [(3, "pending")]
    assert lookups.first_by(df, status="done").count() == 1
    assert [r[0] for r in lookups.page(df, "ingest_id", 2, 3).collect()] == [2, 3, 4]
    assert [r[0] for r in lookups.pending(df, 2).collect()] == [1, 3]


def test_seen_before_uses_doi_or_url(spark):
    hits = spark.createDataFrame([(1, "a", "u1"), (2, "b", "u2"), (3, None, "u2"), (4, "", "u9"), (5, None, None)], "id bigint, doi string, url string")
    works = spark.createDataFrame([("a",), (None,)], "doi string")
    found = spark.createDataFrame([("u2",), (None,)], "url string")
    seen, fresh = lookups.seen_before(hits, works, found)
    assert sorted(r["id"] for r in seen.collect()) == [1, 3]
    assert sorted(r["id"] for r in fresh.collect()) == [2, 4, 5]


def test_content_addressed_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in (("a.bin", b"x"), ("b.bin", b"x")):
        (tmp_path / "in" / name).write_bytes(body)
    empty = spark.createDataFrame([("empty", bytearray())], "path string, content binary")
    stored = files.stored_files(files.read_files(spark, str(tmp_path / "in")).unionByName(empty))
    got = sorted((r["size"], r["copies"], r["file_path"] == r["sha256"] + ".pdf") for r in files.unique_files(stored).collect())
    assert got == [(0, 1, True), (1, 2, True)]
    files.write_files(stored, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_first_and_last_by_key_with_many_copies(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("ord"), F.col("id").cast("string").alias("v"))
    assert dedupe.first_by_key(df, ["k"], ["ord"]).first()["v"] == "0"
    assert dedupe.last_by_key(df, ["k"], ["ord"]).first()["v"] == "4999"


def _lines(spark, folder, n=2000):
    """Line items of different parts, each of them twice."""
    lines = spark.range(n).select(
        F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(0.05).alias("l_discount"),
        F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"),
    )
    lines.unionByName(lines.withColumn("l_discount", F.lit(0.1))).write.parquet(f"{folder}/lineitem.parquet")
    return Inputs(spark, str(folder))


def _most_in_a_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_incoming_edges_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    """With the shuffle's own partitions a task held a quarter of the rows here, however many there were."""
    monkeypatch.setattr(tables, "ROWS_A_TASK", 100)
    _, incoming = catalog._new_edges(_lines(spark, tmp_path))
    assert _most_in_a_task(incoming) < 250
    found = incoming.agg(F.count("*"), F.countDistinct("ord"), F.min("confidence")).first()
    assert tuple(found) == (2000, 2000, 0.1)


def test_edges_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_A_TASK", 100)
    i = _lines(spark, tmp_path)
    assert _most_in_a_task(i.edges) < 250
    assert tuple(i.edges.agg(F.count("*"), F.min("confidence")).first()) == (2000, 0.1)
