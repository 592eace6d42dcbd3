"""Relevance of sentences to queries: scorers, ranking, thresholds and top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.session import written

# Fixed value
RELEVANCE_THRESHOLD = 0.35

SCORE_DIGITS = 9

Scorer = Callable[[DataFrame, str, str], DataFrame]


def tfidf_scorer(sentences: DataFrame, query: str, sentence: str = "sentence") -> DataFrame:
    """Add ``score``: the cosine between the query's TF-IDF vector and the sentence's word set.

    SMART weighting bnc.ltc with a smoothed idf: sentences weigh words by presence, so only the
    document counts of the query's own words are needed - one small aggregate, then one pass
    without a shuffle.
    """
    own = F.array_distinct(tx.words(F.col(sentence)))
    asked = tx.words(F.lit(query))
    shared = F.explode(F.array_intersect(F.array_distinct(asked), own))
    counted = sentences.select(shared.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    # as many rows as the query has words
    counts = {row["word"]: row["df"] for row in counted.collect()}
    total = sentences.count()
    query_words = sentences.sparkSession.range(1).select(asked.alias("w")).first()["w"]
    if not query_words:
        return sentences.withColumn("score", F.lit(0.0))
    weights, length = _query_weights(query_words, counts, total)
    with_words = sentences.withColumn("_own", own)
    weight_of = F.create_map(*[F.lit(part) for item in weights.items() for part in item])
    found = F.array_intersect(F.array(*map(F.lit, weights)), F.col("_own"))
    dot = F.aggregate(found, F.lit(0.0), lambda total, w: total + weight_of[w])
    cosine = F.try_divide(dot, F.lit(length) * F.sqrt(F.size("_own").cast("double")))
    return with_words.withColumn("score", F.round(F.coalesce(cosine, F.lit(0.0)), SCORE_DIGITS)).drop("_own")


def _query_weights(words: Sequence[str], counts: dict[str, int], total: int) -> tuple[dict[str, float], float]:
    idf = {word: np.log((1 + total) / (1 + counts.get(word, 0))) + 1 for word in dict.fromkeys(words)}
    weights = {word: float((1 + np.log(words.count(word))) * idf[word]) for word in idf}
    return weights, float(np.sqrt(sum(w * w for w in weights.values())))


def model_scorer(load: Callable[[], Callable[[Sequence[str], Sequence[str]], Sequence[float]]]) -> Scorer:
    """A scorer from a pair model: ``load()`` gives ``predict(queries, sentences) -> scores``.

    The model is loaded once per task and scores whole batches. Scores are written to the work
    folder, as a sort would otherwise score everything a second time for its sample.
    """

    def score(sentences: DataFrame, query: str, sentence: str = "sentence") -> DataFrame:
        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                yield pd.Series(np.asarray(model([query] * len(batch), list(batch)), dtype="float64"))

        return written(sentences.withColumn("score", predict(F.col(sentence))), "scores")

    return score


def rank_sentences(
    sentences: DataFrame, query: str, order: str = "ord", sentence: str = "sentence", scorer: Scorer = tfidf_scorer
) -> DataFrame:
    """All sentences with their score, best first; equal scores in input order."""
    return scorer(sentences, query, sentence).orderBy(F.desc_nulls_last("score"), order)


def semantic_filter(
    sentences: DataFrame,
    query: str,
    threshold: float = RELEVANCE_THRESHOLD,
    order: str = "ord",
    sentence: str = "sentence",
    scorer: Scorer = tfidf_scorer,
) -> DataFrame:
    """Ranked sentences that score at least ``threshold``."""
    scored = scorer(sentences, query, sentence).filter(F.col("score") >= threshold)
    return scored.orderBy(F.desc_nulls_last("score"), order)


def rank_documents(
    passages: DataFrame, query: str, order: str = "ord", text: str = "text", scorer: Scorer = tfidf_scorer
) -> DataFrame:
    """``(corpus_id, score, text)``, best first; ``corpus_id`` is the passage's place in the input."""
    ranked = scorer(passages, query, text).orderBy(F.desc_nulls_last("score"), order)
    return ranked.select(F.col(order).alias("corpus_id"), "score", text)


def top_sentences(
    sentences: DataFrame, queries: DataFrame, k: int, order: str = "ord", sentence: str = "sentence"
) -> DataFrame:
    """``(query_id, <order>, score, rank)``: the ``k`` best sentences of every query, scores above 0 only; equal scores in order.

    ``queries`` has ``query_id`` and ``query``; both ids are unique and may be of any type that can be ordered. Sentences of one set of words
    score alike and stand as one, with the first ``k`` of them. Every query first scores the shortest sentences of each of its
    words: its kth score there is a bound that its result cannot fall below. A query's words in order of weight say what a
    sentence can still reach if its heaviest word is this one; only words, and sentences short enough, that can reach the bound
    make candidates, which are scored exactly. So a word of every sentence and every query brings in next to nothing.
    """
    own = F.array_sort(F.array_distinct(tx.words(F.col(sentence))))
    held = sentences.select(F.col(order).alias("_order"), own.alias("own")).filter(F.size("own") > 0)
    copies = _first_copies(held.withColumn("key", F.md5(F.array_join("own", " "))), k)
    copies = written(copies, "copies")
    sets = copies.filter(F.col("nth") == 1).select("key", "own")
    weights = written(_weights_of_queries(sentences, queries, own), "weights")
    by_query = weights.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("weight_of"))
    # "key" stands for a set of words, "size" for its number
    postings = sets.select("key", F.size("own").alias("size"), F.explode("own").alias("word"))
    postings = written(postings.join(weights.select("word").distinct(), "word", "left_semi"), "postings")
    shortest = Window.partitionBy("word").orderBy("size", "key")
    champions = postings.withColumn("_nth", F.row_number().over(shortest)).filter(F.col("_nth") <= k)
    first = _scored(champions.join(weights, "word").select("query_id", "key").distinct(), sets, by_query)
    ranked = first.withColumn("_nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "key")))
    bounds = ranked.filter(F.col("_nth") == k).select("query_id", F.col("score").alias("bound"))
    # the margin covers the rounding of scores
    needed = F.coalesce("bound", F.lit(0.0)) - F.lit(10.0 ** (1 - SCORE_DIGITS))
    heavy = weights.join(bounds, "query_id", "left").withColumn("needed", needed).filter(F.col("rest_length") >= F.col("needed"))
    heavy = heavy.select("query_id", "word", "rest_sum", "needed")
    reachable = F.col("rest_sum") >= F.col("needed") * F.sqrt(F.col("size").cast("double"))
    candidates = postings.join(heavy, "word").filter(reachable).select("query_id", "key").distinct()
    scored = _scored(candidates, sets, by_query).filter(F.col("score") > 0)
    # the kth set of a query ends its list: every set gives one sentence at least
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"))
    scored = scored.withColumn("_nth", F.rank().over(kth)).filter(F.col("_nth") <= k)
    rows = scored.join(copies.select("key", "_order"), "key")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "_order")
    rows = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return rows.select("query_id", F.col("_order").alias(order), "score", "rank")


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every ``key`` with their number ``nth``; a task sends on no more of a key."""
    in_order = Window.partitionBy("key").orderBy("_order")
    return rows.withColumn("nth", F.row_number().over(in_order)).filter(F.col("nth") <= k)


def _weights_of_queries(sentences: DataFrame, queries: DataFrame, own: Column) -> DataFrame:
    """``(query_id, word, w, rest_sum, rest_length)``: weights at length one, and sum and length of a word's own and all lesser weights."""
    asked = queries.select("query_id", F.explode(tx.words(F.col("query"))).alias("word"))
    asked = asked.groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("tf"))
    counts = sentences.select(F.explode(own).alias("word")).join(asked.select("word").distinct(), "word", "left_semi")
    counts = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.ln(F.lit(1.0 + sentences.count()) / (1 + F.coalesce("df", F.lit(0)))) + 1
    weighted = asked.join(counts, "word", "left").withColumn("w", (1 + F.ln("tf")) * idf)
    query, rest = Window.partitionBy("query_id"), Window.partitionBy("query_id").orderBy("w", "word")
    unit = weighted.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(query)))
    lengths = F.sqrt(F.sum(F.col("w") * F.col("w")).over(rest))
    return unit.select("query_id", "word", "w", F.sum("w").over(rest).alias("rest_sum"), lengths.alias("rest_length"))


def _scored(pairs: DataFrame, sets: DataFrame, by_query: DataFrame) -> DataFrame:
    """``(query_id, key, score)`` of pairs of a query and a set of words."""
    met = pairs.join(sets, "key").join(by_query, "query_id")
    shared = F.array_intersect("own", F.map_keys("weight_of"))
    dot = F.aggregate(shared, F.lit(0.0), lambda total, word: total + F.col("weight_of")[word])
    return met.select("query_id", "key", F.round(dot / F.sqrt(F.size("own").cast("double")), SCORE_DIGITS).alias("score"))


def rank_sentence(spark: SparkSession, query: str, sentence: str, scorer: Scorer = tfidf_scorer) -> DataFrame:
    """One row ``(query, sentence, score)``."""
    one = spark.range(1).select(F.lit(query).alias("query"), F.lit(sentence).alias("sentence"))
    return scorer(one, query, "sentence")


def rank_pairs(pairs: DataFrame, query: str = "query", sentence: str = "sentence") -> DataFrame:
    """``pairs`` with the ``score`` that ``rank_sentence`` gives each of them; 0 where either has no word."""
    listed = pairs.withColumns({"_asked": tx.words(F.col(query)), "_own": F.array_distinct(tx.words(F.col(sentence)))})
    # of the one sentence, a word is either in all or in none
    missing = F.lit(float(np.log(2.0) + 1))

    def weigh(word):
        times = F.size(F.filter("_asked", lambda other: other == word)).cast("double")
        held = F.array_contains("_own", word)
        return F.struct(((1 + F.ln(times)) * F.when(held, 1.0).otherwise(missing)).alias("w"), held.alias("held"))

    weighed = listed.withColumn("_weights", F.transform(F.array_distinct("_asked"), weigh))
    dot = F.aggregate("_weights", F.lit(0.0), lambda total, x: total + F.when(x["held"], x["w"]).otherwise(0.0))
    square = F.aggregate("_weights", F.lit(0.0), lambda total, x: total + x["w"] * x["w"])
    cosine = F.try_divide(dot, F.sqrt(square) * F.sqrt(F.size("_own").cast("double")))
    return weighed.withColumn("score", F.round(F.coalesce(cosine, F.lit(0.0)), SCORE_DIGITS)).drop("_asked", "_own", "_weights")
