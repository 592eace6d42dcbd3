"""Quality classifier by compression.

One zstandard dictionary is built from text labelled good and one from text labelled bad. A text is
compressed with both, in blocks of ``BLOCK`` bytes so that the dictionaries count for the whole of a
long text as much as for a short one. The difference of the two sizes over their sum is turned into a
probability by a logistic curve, fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm import common

BLOCK = 2048
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
#: Labelled texts of each class used for fitting, and characters of each: the documented bound of the sample.
PER_CLASS, SAMPLE_CHARS = 1500, 4000
KEEP_FROM = 0.3


@dataclass(frozen=True)
class Model:
    """Dictionaries and the curve's slope and intercept; plain bytes and numbers, so that it travels to tasks."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float


def _blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; from too few samples, or ones too alike, the samples' own bytes."""
    blocks = [b for s in samples for b in _blocks(s)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


class Scorer:
    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) / their sum; 0 for an empty text."""
        good = bad = 0
        for block in _blocks(text):
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
        return (bad - good) / (bad + good) if good else 0.0


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of one feature by Newton steps, with a small ridge so that separable data stay finite."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 1e-3 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(sample: list[tuple[str, int]], base_rate: float | None = None) -> Model:
    """From (text, label) pairs: every other one of a class builds its dictionary, the rest fit the curve.

    The curve is moved to ``base_rate``, the share of label 1 among all labelled rows, as the sample holds
    the classes in other shares. Without texts of both classes the score is the base rate (0.5 if unknown).
    """
    by = {y: [t.encode() for t, label in sample if label == y and t] for y in (0, 1)}
    rate = min(max(0.5 if base_rate is None else base_rate, 1e-3), 1 - 1e-3)
    if min(len(v) for v in by.values()) < 2:
        return Model(b"", b"", 0.0, float(np.log(rate / (1 - rate))))
    good, bad = _dictionary(by[1][::2]), _dictionary(by[0][::2])
    scorer = Scorer(good, bad)
    x, y = zip(*((scorer.difference(t), label) for label, found in by.items() for t in found[1::2]), strict=True)
    x, y = np.array(x), np.array(y, dtype=float)
    scale = x.std() or 1.0
    slope, intercept = _curve(x / scale, y)
    held = y.mean()
    return Model(good, bad, slope / scale, intercept + float(np.log(rate / (1 - rate)) - np.log(held / (1 - held))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of the labelled rows outside fold 0."""
    sample = common.labelled_sample(docs, labels, "quality", per_class, chars)
    shares = labels.filter(common.fold() != 0).filter("quality in (0, 1)").agg(F.avg(F.col("quality").cast("double"))).first()
    return fit(sample, shares[0])


def scores(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (all if None) of every row, and ``score``, the chance of label 1.

    A null or empty text has no difference of sizes and gets the curve's value at 0. Columns of ``docs``
    called ``score`` are replaced. One pass, no shuffle.
    """
    held = docs.select(*[c for c in (columns or docs.columns) if c != "score"])
    schema = T.StructType([*held.schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches):
        scorer = Scorer(model.good, model.bad)
        for batch in batches:
            out = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                z = model.slope * scorer.difference(text or b"") + model.intercept
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "score"])

    return held.mapInArrow(score, schema)


def accepted(docs: DataFrame, labels: DataFrame, least: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, columns as they are. One pass, no shuffle."""
    model = train(docs, labels)

    def keep(batches):
        scorer = Scorer(model.good, model.bad)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            z = np.array([model.slope * scorer.difference(t or b"") + model.intercept for t in texts])
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) >= least))

    return docs.mapInArrow(keep, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = scores(common.texts(docs), train(docs, labels))
    return scored.select(
        "doc_id", (common.fold() == 0).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted")
    )
