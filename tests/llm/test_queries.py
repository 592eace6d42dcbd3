"""The registered queries and the pipeline over the smallest tables: against their SQL, or against plain
versions of their stages."""

import re
import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import check_queries  # noqa: E402
import corpus_pipeline  # noqa: E402
from quillmill.llm import decontam, oracle, quality, queries, secrets  # noqa: E402
from quillmill.llm.common import table  # noqa: E402

from .test_operators import WORD, low_words  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check_queries.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    mine = check_queries.rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(oracle.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == check_queries.rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracle.SQL) - {"op12_repair"}))
def test_query_has_a_row_per_document(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    ids = sorted(r["doc_id"] for r in df.collect())
    assert ids == sorted(r["doc_id"] for r in table(spark, FOLDER, "documents").select("doc_id").collect())


def grams(text):
    words = WORD.findall(text)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    model = quality.train(docs, table(spark, FOLDER, "labels"))
    score = quality.Scorer(model.good, model.bad)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    logit = {i: model.slope * score.difference(t.encode()) + model.intercept for i, t in rows.items()}
    kept = {i: t for i, t in sorted(rows.items()) if 1 / (1 + 2.718281828459045 ** -logit[i]) >= quality.KEEP_FROM}
    # one of each group of near duplicates: the least id that a chain of links leads to
    sets, least = {i: grams(t) for i, t in kept.items()}, {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for i in kept:
            for j in kept:
                a, b = sets[i], sets[j]
                if i < j and a and b and least[i] != least[j] and 5 * len(a & b) >= 4 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
                    changed = True
    kept = {i: t for i, t in kept.items() if least[i] == i}
    bench = [low_words(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    size = decontam.WINDOW
    windows = {" ".join(w[k : k + size]) for w in bench if w for k in range(max(1, len(w) - size + 1))}
    joined = {i: f" {' '.join(low_words(t))} " for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if not any(f" {w} " in joined[i] for w in windows)}
    result = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in result) == sorted(kept)
    assert all(r["round_trip"] for r in result)


def test_stages_keep_the_columns(spark):
    docs = table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes


def test_redaction_keeps_clean_texts(spark):
    docs = table(spark, FOLDER, "documents")
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (docs, secrets.redacted(docs)))
    hit = re.compile(r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}|[A-Za-z0-9_-]{24}")
    assert all(before[i] == after[i] for i in before if not hit.search(before[i]))
