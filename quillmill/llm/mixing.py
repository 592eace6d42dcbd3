"""Mixing sources to target weights by systematic sampling.

A source's target is a number of words; every document of a source is expected in the mix
``target / words of the source`` times. The expected copies are summed up along the source and one random offset is
added: a document comes as often as the sum crosses a whole number while it passes. Documents stand in order of
size, so that the words taken differ from the target by about one largest document at most.

Edge cases: a null text has no words and is never missed; a null source is a source of its own, the last one; null or
repeated ids and repeated rows are rows like others (rows of one id and size may change places, with the
same result); an empty table gives no rows; a source without words has target 0 and is taken
by its expected copies, 0. Further columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.operators.running import TASK_BITS, laid_in_order, ranked
from quillmill.session import written

WORD = r"[^\x20\x09-\x0D]+"

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)

#: The mix in words, as a share of all words, and how often a document may be taken at most.
SHARE, MOST = 1.5, 2

SEED = "mix"


def _shuffled() -> Column:
    """Where a document stands among those of its source and size."""
    return F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def _offset(source: str) -> Column:
    """The random offset of a source, in [0, 1), the same in every run."""
    name = F.when(F.col(source).isNull(), F.lit("none")).otherwise(F.concat(F.lit("source:"), F.col(source)))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), name).cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` rows with ``target``.

    Each round resharing gives the excess of sources above ``most`` times their size to the others by weight; a
    round is one sum over the sources, and only sums go by the driver. Few rounds are needed, as each one raises the level.
    """
    order = [F.col("source").asc_nulls_last()]
    numbered = ranked(laid_in_order(sources, order, "_at", "sources"), "_at", "_nth")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("_nth") % len(weights)).cast("int"))
    weighed = written(numbered.select("source", "source_size", weight.cast("double").alias("_weight")), "weighed-sources")
    stop = F.lit(most) * F.col("source_size")
    level = None
    while True:
        above = F.lit(False) if level is None else F.col("_weight") * level[0] / level[1] > stop
        total, capped, left, n = weighed.agg(
            F.sum("source_size"), F.sum(F.when(above, stop)), F.sum(F.when(~above, F.col("_weight"))), F.sum(above.cast("int"))
        ).first()
        if total is None or left is None or (level is not None and n == level[2]):
            break
        level = (share * total - (capped or 0), left, n)
    if level is None:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    shared = F.col("_weight") * F.lit(level[0]) / F.lit(level[1])
    return weighed.select("source", "source_size", F.least(shared, stop.cast("double")).alias("target"))


def _sampled(docs: DataFrame, payload: bool, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Every document with its size, its source's size and target, and ``copies``; the whole row in ``_row`` if wanted."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        *([F.struct(*docs.columns).alias("_row")] if payload else []),
    ).withColumn("_key", _shuffled())
    if not payload:  # dealing out ranges reads its input twice, once for the bounds: words are counted before
        rows = written(rows, "sizes")
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("_key"), F.col("doc_id")]
    placed = laid_in_order(rows, order, "_at", "mixed")
    # by task first: no source meets in one place
    by_task = placed.groupBy("source", F.shiftright("_at", TASK_BITS).alias("_task")).agg(F.sum("size").alias("_words"))
    sources = written(by_task.groupBy("source").agg(F.sum("_words").alias("source_size")), "source-sizes")
    held = targets(sources, weights, share, most).withColumn("_offset", _offset("source"))
    known = ranked(placed, "_at", "_nth", ["source"], held)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    passed = lambda n: F.floor(n * rate + F.col("_offset"))
    crossed = passed(F.col("_nth") + 1) - passed(F.col("_nth"))
    return known.withColumn("copies", F.least(crossed, F.ceil(rate)).cast("bigint"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` of the source and ``taken``, the words that the mix takes of the document."""
    known = _sampled(docs, False, weights, share, most)
    return known.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    known = _sampled(docs, True, weights, share, most).filter("copies > 0")
    return known.select(F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")).select("_row.*")
