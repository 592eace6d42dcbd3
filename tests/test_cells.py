"""Cells with codes: against exact search, and against the same steps in plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.operators import cells, vector_search

RNG = np.random.default_rng(11)
CENTRES = RNG.normal(size=(6, 10)) * 3
POINTS = np.concatenate([c + RNG.normal(size=(50, 10)) for c in CENTRES]).astype("float32")
SCHEMA = "paper_id string, embedding array<float>"


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(f"p{i:03d}", p.tolist()) for i, p in enumerate(POINTS)]
    odd = [("none", None), ("zero", [0.0] * 10), ("short", [1.0, 2.0]), ("nan", [float("nan")] * 10), ("hole", [None] + [1.0] * 9), ("twin", POINTS[3].tolist())]
    return spark.createDataFrame(rows + odd, SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(k, POINTS[i].tolist()) for k, i in enumerate((3, 60, 130, 290))] + [(9, [0.0] * 10), (10, [1.0])]
    return spark.createDataFrame(rows, "query_id bigint, embedding array<float>")


@pytest.fixture(scope="module")
def index(stored):
    return cells.train_index(stored, cells=6, words=16, parts=4, rounds=4)


def rows(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


def test_same_vectors_give_the_same_index(stored, index):
    again = cells.train_index(stored.repartition(2).orderBy(F.desc("paper_id")), cells=6, words=16, parts=4, rounds=4)
    assert (again.centres == index.centres).all() and all((a == b).all() for a, b in zip(again.words, index.words))
    assert [p.stop - p.start for p in index.parts] == [2, 3, 2, 3]


def test_every_vector_is_placed_and_only_odd_ones_have_no_cell(stored, index):
    placed = {r["paper_id"]: r for r in cells.place(stored, index).collect()}
    assert len(placed) == len(POINTS) + 6
    assert {i for i, r in placed.items() if r["cell"] == -1} == {"none", "zero", "short", "nan", "hole"}
    assert all((r["code"] is None) == (r["cell"] == -1) for r in placed.values())
    for i in (0, 77, 299):
        unit = POINTS[i].astype("float64") / np.linalg.norm(POINTS[i].astype("float64"))
        row = placed[f"p{i:03d}"]
        assert row["cell"] == min(range(6), key=lambda c: round(float(((unit - index.centres[c]) ** 2).sum()), 9))
        left = unit - index.centres[row["cell"]]
        assert list(row["code"]) == [
            min(range(len(w)), key=lambda n: round(float(((left[p] - w[n]) ** 2).sum()), 9)) for p, w in zip(index.parts, index.words)
        ]


@pytest.mark.parametrize("block", [4096, 3])
def test_all_cells_and_candidates_give_exact_search(stored, asked, index, monkeypatch, block):
    monkeypatch.setattr(cells, "CODE_BLOCK", block)
    placed = cells.place(stored, index)
    usable = stored.filter(~F.col("paper_id").isin("none", "nan", "hole"))
    exact = rows(vector_search.search_many(usable, asked, k=5))
    assert rows(cells.search_index(placed, stored, asked, index, probes=6, k=5, refine=80)) == exact
    assert {r[0] for r in exact} == {0, 1, 2, 3} and [r[1] for r in exact[:2]] == ["p003", "twin"]


def test_few_cells_and_candidates_find_most(stored, asked, index):
    usable = stored.filter(~F.col("paper_id").isin("none", "nan", "hole"))
    exact = {r[:2] for r in rows(vector_search.search_many(usable, asked, k=10))}
    found = rows(cells.search_index(cells.place(stored, index), stored, asked, index, probes=2, k=10, refine=4))
    assert len({r[:2] for r in found} & exact) >= 0.9 * len(exact)
    assert [r[3] for r in found[:10]] == list(range(1, 11))


def test_a_sample_of_many_vectors(stored, monkeypatch):
    monkeypatch.setattr(cells, "SAMPLE_EACH", 5)
    small = cells.train_index(stored, cells=6, words=8, parts=2, rounds=2)
    assert small.centres.shape == (6, 10) and cells.place(stored, small).filter("cell >= 0").count() == len(POINTS) + 1


def test_nothing_to_learn_from_and_nothing_to_find(spark, stored, asked, index):
    with pytest.raises(ValueError, match="no vector"):
        cells.train_index(spark.createDataFrame([("a", None), ("b", [0.0, 0.0])], SCHEMA))
    placed = cells.place(stored, index)
    assert cells.search_index(placed.limit(0), stored, asked, index, probes=2).count() == 0
    assert cells.search_index(placed, stored, asked.limit(0), index, probes=2).count() == 0
