"""Approximate search for many queries: cells with product-quantised codes, then exact scores of the best candidates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import vectors as vec
from quillmill.operators.vector_search import IVF_CELLS, SEARCH_LIMIT
from quillmill.session import written

# Vectors that the centres and words are learnt from, for each of them; every vector is placed
SAMPLE_EACH = 64
# Code words of a part, and parts of a vector: a code takes a byte a part
CODE_WORDS, CODE_PARTS = 256, 16
ROUNDS = 10
# Candidates scored exactly, for each result asked for
REFINE = 8
# Digits of distances between vectors and centres, of centres, and of scores by codes: equal ones tie whatever the order of summing
DISTANCE_DIGITS, SCORE_DIGITS = 9, 6
CODE_BLOCK = 4096


@dataclass(frozen=True)
class CellIndex:
    """Centres of the cells, and for each part of the dimensions the words that stand for what is left of a vector there."""

    centres: np.ndarray
    words: tuple[np.ndarray, ...]

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    @property
    def parts(self) -> list[slice]:
        return _parts(self.dim, len(self.words))


def _parts(dim: int, count: int) -> list[slice]:
    edges = [dim * i // count for i in range(count + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def train_index(
    vectors: DataFrame,
    cells: int = IVF_CELLS,
    words: int = CODE_WORDS,
    parts: int = CODE_PARTS,
    rounds: int = ROUNDS,
    vector_id: str = "paper_id",
    vector: str = "embedding",
) -> CellIndex:
    """Centres and code words by k-means over a bounded sample of unit vectors.

    The sample is the ``SAMPLE_EACH * max(cells, words)`` usable vectors of least MD5 of their id, the first of them are the first
    centres: the same vectors give the same index, however they are dealt out. The dimension is that of most vectors. Fewer vectors
    than ``cells`` give fewer cells; a table without a usable vector is an error.
    """
    points = _sample(vectors, SAMPLE_EACH * max(cells, words), vector_id, vector)
    centres = _means(points, cells, rounds)
    left = points - centres[_nearest(points, centres)]
    count = min(parts, points.shape[1])
    return CellIndex(centres, tuple(_means(left[:, part], words, rounds) for part in _parts(points.shape[1], count)))


def _sample(vectors: DataFrame, size: int, vector_id: str, vector: str) -> np.ndarray:
    found = vectors.filter(F.size(vector) > 0).groupBy(F.size(vector).alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    commonest = found.orderBy(F.desc("n"), "dim").first()
    if commonest is None:
        raise ValueError("no vector to learn cells from")
    mark = F.md5(F.col(vector_id).cast("string"))
    rows = vectors.filter(F.size(vector) == commonest["dim"]).select(mark.alias("mark"), F.col(vector).cast("array<double>").alias("v"))
    # a task sends what may be in the sample, and not `size` rows of its own: twice the share leaves room for vectors of no use
    share = 2 * size / commonest["n"]
    near = rows.filter(F.conv(F.substring("mark", 1, 8), 16, 10).cast("bigint") < int(share * 2**32)) if share < 1 else rows
    table = near.orderBy("mark").limit(2 * size).toArrow()
    flat = table.column("v").combine_chunks().flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    unit, usable = _unit(flat.reshape(-1, commonest["dim"]))
    if not usable.any():
        raise ValueError("no vector to learn cells from")
    return unit[usable][:size]


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors at length one, and which of them have a direction."""
    lengths = np.linalg.norm(matrix, axis=1)
    usable = np.isfinite(lengths) & (lengths > 0)
    return matrix / np.where(usable, lengths, 1.0)[:, None], usable


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rounded."""
    both = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :]
    return np.round(both - 2 * points @ centres.T, DISTANCE_DIGITS) + 0.0


def _nearest(points: np.ndarray, centres: np.ndarray, block: int = 8192) -> np.ndarray:
    """The nearest centre of every point; the first of equally near ones."""
    chosen = [_distances(points[i : i + block], centres).argmin(axis=1) for i in range(0, len(points), block)]
    return np.concatenate(chosen) if chosen else np.zeros(0, dtype="int64")


def _means(points: np.ndarray, count: int, rounds: int) -> np.ndarray:
    centres = points[:count].copy()
    for _ in range(rounds):
        near = _nearest(points, centres)
        order = np.argsort(near, kind="stable")
        held, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(points[order], first, axis=0)
        centres[held] = np.round(sums / np.bincount(near)[held][:, None], DISTANCE_DIGITS)
    return centres


def place(vectors: DataFrame, index: CellIndex, vector_id: str = "paper_id", vector: str = "embedding") -> DataFrame:
    """``(<vector_id>, cell, code)``: every vector's cell, and a byte a part for what its centre leaves over.

    Vectors that are NULL, of another dimension, without a direction, or with a component that is no number have cell -1 and no
    code. Write the result partitioned by ``cell``: a search then reads the cells it probes, some bytes a vector.
    """
    id_type = dict(vectors.dtypes)[vector_id]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, rows = _matrix(batch.column(1), index.dim)
            cells = np.full(batch.num_rows, -1, dtype="int32")
            cells[rows] = _nearest(matrix, index.centres)
            left = matrix - index.centres[cells[rows]]
            codes = np.stack([_nearest(left[:, p], w) for p, w in zip(index.parts, index.words)], axis=1).astype("uint8")
            listed = np.full(batch.num_rows, None, dtype=object)
            listed[rows] = [row.tobytes() for row in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells), pa.array(listed, pa.binary())], names=[vector_id, "cell", "code"]
            )

    return vectors.select(vector_id, vector).mapInArrow(encode, f"{vector_id} {id_type}, cell int, code binary")


def _matrix(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of a column at length one, and their rows."""
    rows = np.flatnonzero(np.asarray(lists.value_lengths().fill_null(-1)) == dim)
    flat = lists.take(pa.array(rows)).flatten().cast("float64").fill_null(np.nan).to_numpy(zero_copy_only=False)
    unit, usable = _unit(flat.reshape(-1, dim))
    return unit[usable], rows[usable]


def candidates(
    placed: DataFrame, queries: DataFrame, index: CellIndex, probes: int, k: int, vector_id: str = "paper_id"
) -> DataFrame:
    """``(query_id, <vector_id>, score)``: the ``k`` best vectors by code of the ``probes`` nearest cells of every query.

    Queries go to their cells in blocks, and so do codes; a block of codes meets a block of queries once and sends on ``k`` rows a
    query, so the rows shuffled follow the blocks and not the vectors. A cell of a third of all vectors is many blocks, which Spark splits.
    """
    id_type, query_type = dict(placed.dtypes)[vector_id], dict(queries.dtypes)["query_id"]
    names = ["cell", "query_ids", "targets"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, rows = _matrix(batch.column(1), index.dim)
            near = np.argsort(_distances(matrix, index.centres), axis=1, kind="stable")[:, :probes]
            for cell in np.unique(near):
                asked = np.flatnonzero((near == cell).any(axis=1))
                ids = pa.ListArray.from_arrays(pa.array([0, len(asked)], pa.int32()), batch.column(0).take(pa.array(rows[asked])))
                body = pa.array([matrix[asked].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), ids, body], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, order = np.asarray(batch.column(1)), np.asarray(pc.sort_indices(batch.column(0)))
            for cell in np.unique(cells):
                rows = order[cells[order] == cell]
                for start in range(0, len(rows), CODE_BLOCK):
                    chosen = pa.array(rows[start : start + CODE_BLOCK])
                    ids = pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), batch.column(0).take(chosen))
                    body = pa.array([b"".join(batch.column(2).take(chosen).to_pylist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), ids, body], names=["cell", "ids", "codes"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                targets = np.frombuffer(batch.column("targets")[row].as_buffer(), dtype="float64").reshape(-1, index.dim)
                codes = np.frombuffer(batch.column("codes")[row].as_buffer(), dtype="uint8").reshape(-1, len(index.words))
                scores = np.repeat((targets @ index.centres[batch.column("cell")[row].as_py()])[:, None], len(codes), axis=1)
                for number, (part, words) in enumerate(zip(index.parts, index.words)):
                    scores += (targets[:, part] @ words.T)[:, codes[:, number]]
                scores = np.round(scores, SCORE_DIGITS) + 0.0
                # codes lie in order of ids: of equal scores the least ids stay, however many copies there are
                v = np.argsort(-scores, axis=1, kind="stable")[:, :k].ravel()
                q = np.repeat(np.arange(len(targets)), min(k, len(codes)))
                query_ids, ids = batch.column("query_ids")[row].values, batch.column("ids")[row].values
                yield pa.RecordBatch.from_arrays(
                    [query_ids.take(pa.array(q)), ids.take(pa.array(v)), pa.array(scores[q, v])], names=["query_id", vector_id, "score"]
                )

    asked = queries.select("query_id", "embedding").mapInArrow(probe, f"cell int, query_ids array<{query_type}>, targets binary")
    held = placed.filter(F.col("cell") >= 0).select(vector_id, "cell", "code")
    met = held.mapInArrow(pack, f"cell int, ids array<{id_type}>, codes binary").join(asked, "cell")
    found = met.mapInArrow(score, f"query_id {query_type}, {vector_id} {id_type}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), vector_id)
    return found.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).drop("_rank")


def search_index(
    placed: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    index: CellIndex,
    probes: int,
    k: int = SEARCH_LIMIT,
    refine: int = REFINE,
    vector_id: str = "paper_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, <vector_id>, similarity, rank)``: approximately the ``k`` nearest vectors of every query, with exact similarities.

    ``queries`` has ``query_id`` and ``embedding``; both ids are unique and of any type that can be ordered. ``refine * k``
    candidates a query are chosen by code; only these meet their vectors. With all cells probed and ``refine * k`` at least the number of vectors the result is
    that of exact search. Queries without a direction, or of another dimension, find nothing.
    """
    chosen = written(candidates(placed, queries, index, probes, k * refine, vector_id).drop("score"), "candidates")
    asked = queries.select("query_id", F.col("embedding").alias("_asked"))
    paired = chosen.join(vectors.select(vector_id, F.col(vector).alias("_held")), vector_id).join(asked, "query_id")
    similarity = F.round(vec.cosine_similarity(F.col("_held"), F.col("_asked")), vec.SIMILARITY_DIGITS)
    scored = paired.select("query_id", vector_id, similarity.alias("similarity"))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), vector_id)
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
