"""The registered queries against their SQL at the smallest scale, where tables are at hand."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

ROOT = Path(__file__).resolve().parent.parent
FOLDER = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402
from quillmill.plans import catalog, oracle  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")

QUERIES, SQL = dict(catalog.REGISTRY), dict(oracle.SQL)
# covered by tests/test_streaming.py; each takes seconds for its many small writes
SLOW = {"stream_ingest_children", "stream_ingest_dashboard", "topic_to_papers"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check_queries.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_sql_text_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).columns == ["paper_id", "title", "similarity"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = check_queries.rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = SQL.get(name)
    if sql is None:
        assert mine
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == check_queries.rows_of(columns, result.fetchall())
