"""What the operators of this subpackage share: inputs, folds, bounded samples, word hashes.

Rows are told apart by ``doc_id`` and a hash of the text (``row_key``): repeated rows are equal in both
and get equal results, and rows that share an id but not a text are kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that parts words: the space and code points 9 to 13. bytes.split() parts at the same six.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text is empty."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's digits, modulo five (a null id counts as the empty string)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def packed(docs: DataFrame) -> DataFrame:
    """The caller's rows in one column ``kept_row``, beside ``doc_id`` and ``row_key``: whatever their columns are called, nothing clashes."""
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("kept_row")
    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(row, doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row_key"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition of two tables that both carry ``doc_id`` and ``row_key``."""
    return (left["row_key"] == right["row_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, chars: int) -> list[tuple[str, int]]:
    """At most ``per_class`` labelled texts of each class, outside fold 0, as (text, label) on the driver.

    The bound is for fitting alone: ids are taken in the order of a hash, and of a text longer than
    ``chars`` a piece that begins at a place given by the same hash.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(fold() != 0).filter("y in (0, 1)").distinct().withColumn("h", F.xxhash64("doc_id", F.lit("sample")))
    picked = None
    for y in (0, 1):
        one = known.filter(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    found = texts(docs).join(F.broadcast(picked), "doc_id")  # at most 2 * per_class rows of three numbers
    room = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    piece = F.substring(F.col("text"), (F.pmod(F.col("h"), room) + 1).cast("int"), F.lit(chars))
    rows = found.select(piece.alias("piece"), "y", "h", "doc_id").orderBy("h", "doc_id", "piece").limit(2 * per_class).collect()
    return [(r["piece"], r["y"]) for r in rows]


def batches_of(iterator: Iterator, column: str = "text", size: int = 3_000_000) -> Iterator:
    """Arrow batches cut so that the texts of each come to about ``size`` bytes; a text is never cut."""
    for batch in iterator:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def joined_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array, and the n + 1 offsets of the texts in it."""
    values = [b"" if v is None else v for v in column.cast("large_binary").to_pylist()]
    offsets = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return np.frombuffer(b"".join(values), dtype=np.uint8), offsets


def _mix(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _mix(11, 256)
_STEP = _mix(12, 1)[0]
_POWERS = np.multiply.accumulate(np.full(4096, _STEP, dtype=np.uint64))


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than the six blanks) of texts laid end to end: starts, ends, and the text of each."""
    gap = np.zeros(256, dtype=bool)
    gap[[9, 10, 11, 12, 13, 32]] = True
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~gap[data]
    # a text's end parts words as well
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: random odd numbers of its bytes, summed with powers of another one, then scrambled."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    rows = np.repeat(starts, sizes) + at
    powers = _POWERS
    if sizes.max() > len(powers):
        powers = np.multiply.accumulate(np.full(int(sizes.max()), _STEP, dtype=np.uint64))
    total = np.add.reduceat(_BYTE[data[rows]] * powers[at], first)
    return _scramble(total + sizes.astype(np.uint64) * _mix(13, 1)[0])
