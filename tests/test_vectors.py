import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.functions import vectors as vec
from quillmill.operators import documents, vector_search as vs

RNG = np.random.default_rng(5)
VECTORS = RNG.normal(size=(60, 8)).astype("float32")


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(i, ["title", "abstract"][i % 2], v.tolist()) for i, v in enumerate(VECTORS)]
    rows += [(60, "title", None), (61, "title", [0.0] * 8), (62, "title", [1.0, 2.0]), (63, "abstract", VECTORS[3].tolist())]
    return spark.createDataFrame(rows, "paper_id bigint, embedding_type string, embedding array<float>").repartition(5)


@pytest.fixture(scope="module")
def papers(spark):
    return spark.createDataFrame([(i, f"title {i}") for i in range(64) if i != 5], "id bigint, title string")


def similarities(query):
    v = VECTORS.astype("float64")
    sims = {i: s for i, s in enumerate(v @ query / np.linalg.norm(v, axis=1) / np.linalg.norm(query))}
    sims[63] = sims[3]
    return {i: round(float(s), 9) for i, s in sims.items()}


def best(sims, k, drop=()):
    return sorted((i for i in sims if i not in drop), key=lambda i: (-sims[i], i))[:k]


def test_similarity_forms_agree(spark, stored):
    query = VECTORS[0].astype("float64").tolist()
    both = stored.select(
        "paper_id", vec.similarity_to(query)("embedding").alias("a"),
        vec.cosine_similarity(F.col("embedding"), vec.vector_literal(query)).alias("b"),
    )
    for r in both.collect():
        if r["paper_id"] in (60, 61, 62):
            assert r["a"] is None and r["b"] is None
        else:
            assert abs(r["a"] - r["b"]) < 1e-8


def test_threshold_is_strict_and_unknown_papers_drop_out(stored, papers):
    query = VECTORS[3].astype("float64")
    sims = similarities(query)
    got = vs.find_similar_papers(stored, papers, query.tolist(), 0.2, 10).collect()
    want = [i for i in best(sims, 64, drop={5}) if sims[i] > 0.2][:10]
    assert [r["paper_id"] for r in got] == want and got[0]["title"] == "title 3"
    edge = sims[want[2]]
    assert len(vs.find_similar_papers(stored, papers, query.tolist(), edge, 10).collect()) == 2
    only = vs.find_similar_papers(stored, papers, query.tolist(), 0.0, 50, embedding_type="title").collect()
    assert {r["paper_id"] % 2 for r in only} == {0}


def test_best_per_paper(spark, papers):
    rows = [(1, "title", [1.0, 0.0]), (1, "abstract", [1.0, 0.1]), (2, "title", [1.0, 0.2])]
    df = spark.createDataFrame(rows, "paper_id bigint, embedding_type string, embedding array<float>")
    assert [r["paper_id"] for r in vs.find_similar_papers(df, papers, [1.0, 0.0], 0.1).collect()] == [1, 1, 2]
    assert [r["paper_id"] for r in vs.find_similar_papers(df, papers, [1.0, 0.0], 0.1, best_per_paper=True).collect()] == [1, 2]


def test_nearest_chunks_puts_missing_vectors_last(stored):
    chunks = stored.withColumnRenamed("paper_id", "chunk_id")
    got = vs.nearest_chunks(chunks, VECTORS[3].tolist(), limit=64).collect()
    assert [r["chunk_id"] for r in got[:2]] == [3, 63]
    assert [r["chunk_id"] for r in got[-3:]] == [60, 61, 62]


@pytest.mark.parametrize("blocks", [(1024, 2048), (1, 7), (2, 1)])
def test_many_queries_equal_brute_force(spark, stored, blocks):
    q_block, v_block = blocks
    asked = {11: VECTORS[3], 12: VECTORS[9], 13: RNG.normal(size=8)}
    rows = [(k, [float(x) for x in v]) for k, v in asked.items()] + [(14, [0.0] * 8)]
    queries = spark.createDataFrame(rows, "query_id bigint, embedding array<double>")
    for threshold in (None, 0.3):
        got = vs.search_many(stored, queries, k=5, similarity_threshold=threshold, query_block=q_block, vector_block=v_block).orderBy("query_id", "rank").collect()
        want = []
        for k, v in asked.items():
            sims = similarities(np.asarray(v, dtype="float64"))
            want += [(k, i) for i in best(sims, 5) if threshold is None or sims[i] > threshold]
        assert [(r["query_id"], r["paper_id"]) for r in got] == want


def test_many_queries_with_ids_of_any_type(spark, stored):
    named = stored.select(F.concat(F.lit("chunk-"), F.lpad(F.col("paper_id").cast("string"), 3, "0")).alias("chunk_id"), "embedding")
    queries = spark.createDataFrame([(f"q{k}", [float(x) for x in VECTORS[k]]) for k in range(30)], "query_id string, embedding array<double>")
    got = vs.search_many(named, queries, k=4, vector_id="chunk_id", query_block=4, vector_block=9).orderBy("query_id", "rank").collect()
    want = [(f"q{k}", f"chunk-{i:03d}") for k in sorted(range(30), key=lambda k: f"q{k}") for i in best(similarities(VECTORS[k].astype("float64")), 4)]
    assert [(r["query_id"], r["chunk_id"]) for r in got] == want
    assert vs.search_many(named, queries.limit(0), vector_id="chunk_id").collect() == []


def test_results_that_a_task_cannot_hold_are_sent_on(spark, stored, monkeypatch):
    queries = spark.createDataFrame([(k, [float(x) for x in VECTORS[k]]) for k in range(20)], "query_id bigint, embedding array<double>")
    whole = vs.search_many(stored, queries, k=3).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(vs, "HELD_RESULTS", 5)
    assert vs.search_many(stored, queries, k=3, query_block=3, vector_block=4).orderBy("query_id", "rank").collect() == whole


def test_cells_find_what_exact_search_finds(spark):
    centres = RNG.normal(size=(6, 16)) * 4
    points = np.concatenate([c + RNG.normal(size=(40, 16)) for c in centres])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "paper_id bigint, embedding array<float>")
    model = vs.train_cells(df, cells=6)
    placed = vs.assign_cells(df.union(spark.createDataFrame([(999, [0.0] * 16)], df.schema)), model)
    query = points[7].tolist()
    exact = vs.search_cells(placed, model, query, probes=6)
    brute = df.select("paper_id", vec.similarity_to(query)("embedding").alias("s")).orderBy(F.desc("s"), "paper_id").limit(10)
    assert [r["paper_id"] for r in exact.collect()] == [r["paper_id"] for r in brute.collect()]
    assert vs.recall(vs.search_cells(placed, model, query, probes=2), exact, ["paper_id"]).first()[0] >= 0.9
    assert placed.filter("paper_id = 999").first()["cell"] == -1


def test_wrong_dimension(stored):
    assert [(r["paper_id"], r["dims"]) for r in vs.wrong_dimension(stored, 8).collect()] == [(62, 2)]


def test_hash_embedder_counts_words(spark):
    df = spark.createDataFrame([("a b a",), ("A  b a",)], "section_text string")
    one, two = [np.array(r["embedding"]) for r in vs.hash_embedder(32)(df).collect()]
    assert np.allclose(one, two) and sorted(np.round(one[one > 0] ** 2 * 5, 4)) == [1.0, 4.0]


def test_single_failures_are_tolerated(spark, rows):
    texts = spark.createDataFrame([(1, "x" * 500), (2, "bad"), (3, " ")], "id bigint, t string")

    def load():
        def encode(values):
            if any(v == "bad" for v in values):
                raise ValueError("no")
            return [[float(len(v))] for v in values]

        return encode

    done, rejects = vs.embed_sections(documents.sections(texts, "t", "id"), vs.model_embedder(load), "id")
    assert rows(done) == [(1, "abstract", [300.0]), (1, "full_text", [500.0]), (1, "title", [200.0])]
    assert rows(rejects) == [("embed", "2", "no_embedding")]


def test_sql_functions(spark, stored, papers):
    stored.createOrReplaceTempView("t_vectors")
    papers.createOrReplaceTempView("t_papers")
    vec.register_find_similar_papers(spark, "t_vectors", "t_papers")
    query = ", ".join(f"{float(x)}D" for x in VECTORS[3])
    got = spark.sql(f"SELECT paper_id FROM find_similar_papers(array({query})) ORDER BY similarity DESC, paper_id LIMIT 10").collect()
    want = vs.find_similar_papers(stored, papers, VECTORS[3].tolist()).collect()
    assert [r[0] for r in got] == [r["paper_id"] for r in want]
    assert spark.sql("SELECT cosine_distance(array(1D, 0D), array(0D, 0D))").first()[0] is None
    parsed = spark.createDataFrame([("[0.5, 1]",), ("x",)], "s string").select(vec.parse_vector(F.col("s"))).collect()
    assert [r[0] for r in parsed] == [[0.5, 1.0], None]


def test_parts_of_a_section_are_pooled_by_length(spark):
    parts = [(1, "full_text", 30.0, [1.0, 0.0]), (1, "full_text", 10.0, [0.0, 1.0]), (1, "title", 5.0, [0.6, 0.8]),
             (2, "full_text", 9.0, None), (2, "title", 9.0, None), (3, "full_text", 1.0, None), (3, "full_text", 2.0, [2.0, 0.0])]
    df = spark.createDataFrame(parts, "id bigint, embedding_type string, _chars double, embedding array<float>")
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    done, rejects = vs.split_embedded(vs.pooled(df, "id"), "id", asked)
    got = {(r["id"], r["embedding_type"]): [round(x, 5) for x in r["embedding"]] for r in done.collect()}
    assert got == {(1, "full_text"): [round(3 / 10**0.5, 5), round(1 / 10**0.5, 5)], (1, "title"): [0.6, 0.8], (3, "full_text"): [2.0, 0.0]}
    assert sorted(r["key"] for r in rejects.collect()) == ["2", "4"]


def test_vectors_of_sections_are_pooled_once(spark):
    """They are read back by the store, the rejects and the log; each of these pooled them anew."""
    texts = spark.createDataFrame([("a", "one two"), ("b", "three")], "id string, t string")
    done, rejects = vs.embed_sections(documents.sections(texts, "t", "id"), vs.hash_embedder(8), "id", among=texts)
    assert "Aggregate" not in done._jdf.queryExecution().optimizedPlan().toString()
    assert done.count() == 4 and rejects.count() == 0
