"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt into cells of anchors and candidates. A task takes the candidates of a cell in blocks, sorted by label, and keeps a list
of each block's rows sorted by every dimension. The lists are read from their ends in growing steps; rows met for the first time
are scored by whole-number inner products with all anchors that still look (random access, one matrix product). What no list has
shown yet cannot score more than an anchor's threshold: the sum over the dimensions of its component times the next value at the
end of the list that the component's sign asks for. An anchor stops in a block once its threshold is strictly below the kth score of each of its
windows (or below the window's least score, while there are fewer than k), as equal scores are told apart by id.

A first pass finds each anchor's positives, whose scores make the windows of the second. No list, no anchor's candidates and no label meet
in one task: each cell sends on at most k rows for an anchor's window.

Edge cases: rows with a null label, vector or component, or a component that is not finite, take no part, nor do rows without an
id. Of rows that share an id the least by label, then vector counts. Shorter vectors count as ending in zeros. Scores are exact while the
sum of the components' products is below 2^62; beyond that they stop there. Fewer than k rows give fewer; a positive of negative score has no window.
Empty tables give no rows; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill.session import written

#: Every how many ids one is an anchor; positives of an anchor; negatives of a positive.
EVERY, POSITIVES, NEGATIVES = 50, 5, 3

#: Anchors of a cell, into how many cells the candidates of a set of anchors are dealt, rows of a block, anchors of a matrix product.
ANCHORS, SALTS, BLOCK, TOGETHER = 8192, 32, 4096, 256

#: Rows that each end of a list has shown after a step; then all.
STEPS = (0, 4, 16, 64, 256)

_NONE = -(1 << 62)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and whole-number ``vector``, one row for an id."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    limit = float(1 << 62)  # floor() of a double beyond a long is no long
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * 256, F.lit(limit)), F.lit(-limit))))
    least = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(label.alias("label"), whole.alias("vector")).alias("row"))
    return least.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


# -- in a task ------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    values = np.asarray(column.flatten(), dtype=np.int64)
    if len(sizes) and (sizes == sizes[0]).all():
        return values.reshape(len(sizes), int(sizes[0]))
    found = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    found[np.arange(found.shape[1]) < sizes[:, None]] = values
    return found


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


class Best:
    """The k best rows of each window so far: scores and ids, best first, ties by smaller id."""

    def __init__(self, windows: int, k: int):
        self.k = k
        self.scores = np.full((windows, k), _NONE, dtype=np.int64)
        self.ids = np.zeros((windows, k), dtype=np.int64)

    def add(self, window: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, at = np.unique(window, return_inverse=True)
        if not len(touched):
            return
        at = np.concatenate([at, np.repeat(np.arange(len(touched)), self.k)])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, at))
        starts = np.searchsorted(at[order], np.arange(len(touched)))
        best = order[(starts[:, None] + np.arange(self.k))]
        self.scores[touched], self.ids[touched] = scores[best], ids[best]


class Anchors:
    """Anchors sorted by label, each with the same number of windows ``low`` to ``high`` of scores and the best rows in them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.vectors, self.low, self.high, self.same = ids, labels, vectors, low, high, same
        self.k, self.n_windows = k, low.shape[1]
        self.best = Best(len(ids) * self.n_windows, k)

    def floor(self, which: np.ndarray) -> np.ndarray:
        """The least score that could still count, in each window of some anchors."""
        kth = self.best.scores[:, -1].reshape(len(self.ids), self.n_windows)[which]
        return np.where(self.low[which] > self.high[which], np.iinfo(np.int64).max, np.maximum(kth, self.low[which]))


def _exact(vectors: np.ndarray, others: np.ndarray) -> type:
    """The number type in which inner products of two sets of vectors are whole: doubles to 2^53, else long doubles."""
    most = np.abs(vectors).sum(axis=1, dtype=np.float64).max(initial=0) * np.abs(others).astype(np.float64).max(initial=0)
    return np.float64 if most < 2**52 else np.longdouble


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != np.float64:
        scores = np.clip(scores, 1 - 2**62, 2**62)
    return scores.astype(np.int64)


def look(anchors: Anchors, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> int:
    """Threshold algorithm of all anchors over one block of rows; returns how many scores it worked out."""
    n, width = vectors.shape
    if anchors.vectors.shape[1] != width:
        width = max(width, anchors.vectors.shape[1])
        vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        anchors.vectors = np.pad(anchors.vectors, ((0, 0), (0, width - anchors.vectors.shape[1])))
    present = np.unique(labels)
    if anchors.same:
        wanted = np.flatnonzero(np.isin(anchors.labels, present))
    else:
        wanted = np.flatnonzero(anchors.labels != present[0]) if len(present) == 1 else np.arange(len(anchors.ids))
    kind = _exact(anchors.vectors, vectors)
    lists = np.sort(vectors, axis=0).astype(kind)  # every dimension's list, least first
    rank = np.empty((n, width), dtype=np.int32)
    if width:
        np.put_along_axis(rank, np.argsort(vectors, axis=0, kind="stable"), np.arange(n, dtype=np.int32)[:, None], axis=0)
        met = np.minimum(rank, n - 1 - rank).min(axis=1)  # after how many entries of either end a row is met
    else:
        met = np.zeros(n, dtype=np.int32)
    by_meeting = np.argsort(met, kind="stable")
    met, vectors, ids, labels = met[by_meeting], vectors[by_meeting].astype(kind), ids[by_meeting], labels[by_meeting]
    scored = 0
    for start in range(0, len(wanted), TOGETHER):
        looking = wanted[start : start + TOGETHER]
        done = 0
        for shown in [s for s in STEPS if 2 * s < n] + [n]:
            stop = int(np.searchsorted(met, shown))
            if stop > done:
                _score(anchors, looking, ids[done:stop], labels[done:stop], vectors[done:stop], kind)
                scored += len(looking) * (stop - done)
                done = stop
            if done == n or not len(looking):
                break
            signed = anchors.vectors[looking].astype(kind)
            threshold = np.maximum(signed, 0) @ lists[n - 1 - shown] + np.minimum(signed, 0) @ lists[shown]
            looking = looking[(threshold[:, None] >= anchors.floor(looking)).any(axis=1)]
    return scored


def _score(anchors: Anchors, looking: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, kind: type) -> None:
    scores = _longs(anchors.vectors[looking].astype(kind) @ vectors.T)
    apart = anchors.labels[looking][:, None] != labels[None, :]
    if anchors.same:
        apart = apart | (anchors.ids[looking][:, None] == ids[None, :])
    scores[apart if anchors.same else ~apart] = _NONE
    floor = anchors.floor(looking)
    for w in range(anchors.n_windows):
        inside = np.where(scores <= anchors.high[looking, w][:, None], scores, _NONE)
        least = np.maximum(floor[:, w], _NONE + 1)
        if inside.shape[1] > anchors.k:
            least = np.maximum(least, np.partition(inside, -anchors.k, axis=1)[:, -anchors.k])
        rows, columns = np.nonzero(inside >= least[:, None])
        anchors.best.add(looking[rows] * anchors.n_windows + w, inside[rows, columns], ids[columns])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.Table]]:
    """Runs of rows of one cell and kind: all anchors of a cell at once, its candidates in blocks that end with a label if they can."""
    held, key = [], None
    for batch in batches:
        columns = [np.asarray(batch.column(c)) for c in ("cell", "salt", "kind", "label")]
        cuts = np.flatnonzero((np.diff(np.stack(columns), axis=1) != 0).any(axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == b:
                continue
            at = tuple(int(c[a]) for c in columns[:3])
            size = sum(h.num_rows for h in held)
            if held and (at != key or at[2] and size >= BLOCK // 16):
                yield key[:2], key[2], pa.Table.from_batches(held)
                held, size = [], 0
            key = at
            for start in range(a, b, BLOCK):
                held.append(batch.slice(start, min(BLOCK, b - start)))
                size += held[-1].num_rows
                if key[2] and size >= BLOCK:
                    yield key[:2], key[2], pa.Table.from_batches(held)
                    held, size = [], 0
    if held:
        yield key[:2], key[2], pa.Table.from_batches(held)


def _found(anchors: Anchors) -> dict[str, np.ndarray]:
    scores = anchors.best.scores
    window, place = np.nonzero(scores != _NONE)
    return {"anchor_id": anchors.ids[window // anchors.n_windows], "window": (window % anchors.n_windows).astype(np.int32),
            "found_id": anchors.best.ids[window, place], "score": scores[window, place]}


_FOUND = "anchor_id bigint, window int, found_id bigint, score bigint"


def _cells(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = to_arrow_schema(StructType.fromDDL(_FOUND))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors = None, None
        for key, kind, rows in _blocks(batches):
            if key != cell:
                if anchors is not None:
                    yield pa.RecordBatch.from_pydict(_found(anchors), schema=schema)
                cell, anchors = key, None
            ids, labels = (np.asarray(rows.column(c).combine_chunks(), dtype=np.int64) for c in ("vec_id", "label"))
            vectors = _stacked([_matrix(c) for c in rows.column("vector").chunks])
            if kind == 0:
                low, high = (_stacked([_matrix(c) for c in rows.column(w).chunks]) for w in ("low", "high"))
                anchors = Anchors(ids, labels, vectors, low, high, k, same)
            elif anchors is not None:
                look(anchors, ids, labels, vectors)
        if anchors is not None:
            yield pa.RecordBatch.from_pydict(_found(anchors), schema=schema)

    return each


# -- over Spark -----------------------------------------------------------------------------------------------


def _best_in_windows(rows: DataFrame, anchors: DataFrame, cells: int, k: int, same: bool) -> DataFrame:
    """The k best rows of every window of the anchors (``vec_id``, ``label``, ``vector``, ``low``, ``high``), with their rank."""
    cell = F.pmod(F.xxhash64("vec_id"), F.lit(cells)).cast("int")
    looking = anchors.withColumn("cell", cell).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("kind", F.lit(0))
    salt = F.pmod(F.xxhash64("vec_id", F.lit("salt")), F.lit(SALTS)).cast("int")
    none = F.array().cast("array<bigint>")
    offered = rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).withColumn("salt", salt).withColumn("kind", F.lit(1))
    columns = ["cell", "salt", "kind", "label", "vec_id", "vector", "low", "high"]
    met = looking.select(*columns).unionByName(offered.withColumn("low", none).withColumn("high", none).select(*columns))
    # a stated number of tasks: the work grows with anchors times rows, not with the bytes
    dealt = met.repartition(min(cells * SALTS, 20_000), "cell", "salt").sortWithinPartitions("cell", "salt", "kind", "label", "vec_id")
    found = dealt.mapInArrow(_cells(k, same), _FOUND)
    best = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels that score half to 95 % of the positive."""
    rows = written(usable(embeddings), "vectors")
    chosen = rows.filter(F.col("vec_id") % every == 0)
    cells = max(1, -(-chosen.count() // ANCHORS))
    whole = lambda x: F.array(F.lit(x).cast("bigint"))
    anchors = chosen.withColumn("low", whole(_NONE + 1)).withColumn("high", whole((1 << 63) - 1))
    near = written(_best_in_windows(rows, anchors, cells, positives, True), "positives")
    # ceil(50 p / 100) and floor(95 p / 100) without leaving the range of a long
    windows = near.filter("score >= 0").select(
        "anchor_id", "rank", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr("score div 2 + score % 2").alias("low"), F.expr("score div 100 * 95 + (score % 100) * 95 div 100").alias("high"),
    )
    # a window for each positive, in their order; missing ones are empty
    slots = [F.max(F.when(F.col("rank") == r, F.col(c))) for c in ("low", "high") for r in range(1, positives + 1)]
    empty = {"low": 1, "high": 0}
    packed = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(*[
        F.array(*[F.coalesce(slots[j * positives + r], F.lit(empty[c]).cast("bigint")) for r in range(positives)]).alias(c)
        for j, c in enumerate(("low", "high"))
    ])
    found = _best_in_windows(rows, chosen.join(packed, "vec_id"), cells, negatives, False)
    named = windows.select("anchor_id", (F.col("rank") - 1).cast("int").alias("window"), "positive_id", "positive_score")
    return found.join(named, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
