"""Benchmark decontamination by a positional inverted index, in DataFrame functions alone.

The index holds postings (term, document, position) of the terms that test phrases are looked up by, with
the words around each position, which are the positions of all other terms that matter for that posting.
For each phrase the corpus counts name its rarest terms. Only the rarest one has postings; moved by its
offset in the phrase they give the places where the phrase could start. The next rarest terms are looked
up in the words around, and what is left is compared word by word. Proximity matches ask for
an item's rarest terms within a span of words, in any order.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.session import written

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window; a shorter item is one window.
WINDOW = 10
#: Rarest terms of a phrase that are intersected before words are compared.
RAREST = 3
#: Test tables of up to this many windows are sent to every task; larger ones are joined by shuffle.
BROADCAST_WINDOWS = 100_000


def words(text: Column) -> Column:
    """Lower-case (A-Z only) words of a text; none of a null."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, WORD_BREAK), "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id (as string) and ``window``, an array of words; repeated ones once."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")).distinct()


def _sent(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def documents_of(docs: DataFrame) -> DataFrame:
    return common.texts(docs).withColumn("row_key", common.row_key())


def term_counts(docs: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """How often each of ``terms`` occurs in all documents; counted in each task before the shuffle."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return tokens.join(_sent(terms, small), "term").groupBy("term").agg(F.count("*").alias("n"))


def rarest_terms(phrases: DataFrame, counts: DataFrame, how_many: int = RAREST, known: bool = False) -> DataFrame:
    """For each ``window``: ``rare``, its rarest (n, off, term) in order, ties by offset. Windows with a term
    that no document has cannot occur and go; with ``known``, terms that some document has are ranked alone."""
    spread = phrases.select("window", F.posexplode("window").alias("off", "term")).join(counts, "term", "inner" if known else "left")
    rare = spread.groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("rare")
    )
    return rare.filter(F.col("rare")[0]["n"] > 0).withColumn("rare", F.slice("rare", 1, how_many))


def postings(docs: DataFrame, terms: DataFrame, radius: int, small: bool) -> DataFrame:
    """The index: term, doc_id, row_key, pos (from 0), and the words from ``lo`` to ``radius`` beyond pos.

    Words are joined with the wanted terms before anything else is taken from the text, so only their
    positions become rows. The empty term stands behind the last word of every document: its position is
    the number of words, so that lengths need no further pass over the texts.
    """
    wanted = terms.select("term").unionByName(docs.sparkSession.createDataFrame([("",)], "term string"))
    spread = documents_of(docs).select("doc_id", "row_key", words(F.col("text")).alias("w"))
    # the outer form: for the plain one Spark would work out the words once more, to filter on their number
    spread = spread.select("doc_id", "row_key", "w", F.posexplode_outer(F.concat("w", F.array(F.lit("")))).alias("pos", "term"))
    lo = F.greatest(F.col("pos") - radius, F.lit(0))
    around = F.when(F.col("term") != "", F.slice("w", lo + 1, F.col("pos") - lo + radius + 1))
    return spread.join(_sent(wanted, small), "term").select("term", "doc_id", "row_key", "pos", lo.alias("lo"), around.alias("around"))


def phrase_matches(index: DataFrame, rare: DataFrame, small: bool) -> DataFrame:
    """doc_id, row_key, start, ``window`` of each exact occurrence of a window."""
    probe = rare.select(F.col("rare")[0]["term"].alias("term"), F.col("rare")[0]["off"].alias("off"), "rare", "window")
    start = F.col("pos") - F.col("off")
    at = lambda off: F.get("around", start + off - F.col("lo"))  # noqa: E731  null outside the text
    hits = index.join(_sent(probe, small), "term").filter(start >= 0)
    hits = hits.filter(F.forall(F.slice("rare", 2, RAREST), lambda r: F.coalesce(at(r["off"]) == r["term"], F.lit(False))))
    hits = hits.filter(F.slice("around", F.greatest(start - F.col("lo") + 1, F.lit(1)), F.size("window")) == F.col("window"))
    return hits.select("doc_id", "row_key", start.alias("start"), "window")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, span: int = 20, terms: int = RAREST) -> DataFrame:
    """doc_id, item_id, n_places: places of an item's rarest term with its other rare terms within ``span`` words.

    An item's ``terms`` rarest different words of those that the corpus has must all be in reach, in any
    order; an item of fewer such words asks for those it has.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.array_distinct(words(F.col("text"))).alias("window"))
    items = items.filter(F.size("window") > 0)
    small = items.count() <= BROADCAST_WINDOWS
    rare = written(rarest_terms(items.select("window").distinct(), term_counts(docs, _terms(items), small), terms, known=True), "rare-terms")
    index = postings(docs, rare.select(F.col("rare")[0]["term"].alias("term")).distinct(), span - 1, small)
    probe = rare.select(F.col("rare")[0]["term"].alias("term"), F.transform("rare", lambda r: r["term"]).alias("all"), "window")
    met = index.join(_sent(probe, small), "term").filter(F.size(F.array_intersect("around", "all")) == F.size("all"))
    places = met.select("doc_id", "row_key", "pos", "window").distinct().join(items, "window")
    return places.groupBy("doc_id", "row_key", "item_id").agg(F.count("*").alias("n_places")).drop("row_key")


def _terms(phrases: DataFrame) -> DataFrame:
    return phrases.select(F.explode("window").alias("term")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Two tables: doc_id, row_key, n_words of every row; and doc_id, row_key, n_hit and ``items`` (sorted item
    ids) of every document with an occurrence of a window."""
    held = written(windows(benchmark, size), "test-windows")
    small = held.count() <= BROADCAST_WINDOWS
    phrases = held.select("window").distinct()
    rare = written(rarest_terms(phrases, term_counts(docs, _terms(phrases), small)), "rare-terms")
    wanted = rare.select(F.col("rare")[0]["term"].alias("term")).distinct()
    index = written(postings(docs, wanted, size - 1, small), "postings")
    hits = written(phrase_matches(index, rare, small).distinct(), "phrase-matches")
    stops = hits.groupBy("doc_id", "row_key", "start").agg(F.max(F.col("start") + F.size("window")).alias("stop"))
    # a document's occurrences in order: each adds the words beyond the furthest end so far
    before = "max(stop) OVER (PARTITION BY doc_id, row_key ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    fresh = stops.selectExpr("doc_id", "row_key", f"greatest(stop - greatest(start, coalesce({before}, 0)), 0) AS fresh")
    covered = fresh.groupBy("doc_id", "row_key").agg(F.sum("fresh").alias("n_hit"))
    found = hits.join(_sent(held, small), "window").select("doc_id", "row_key", "item_id").distinct()
    items = found.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = covered.join(items, common.same_row(covered, items)).select(covered["doc_id"], covered["row_key"], "n_hit", "items")
    return index.filter("term = ''").select("doc_id", "row_key", F.col("pos").cast("bigint").alias("n_words")), found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hits; without test items nothing is contaminated; repeated
    rows get the same result each.
    """
    left, found = contamination(docs, benchmark)
    met = left.join(found, common.same_row(left, found), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return met.select(
        left["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a test window, columns as they are."""
    found, rows = contamination(docs, benchmark)[1], common.packed(docs)
    return rows.join(found, common.same_row(rows, found), "left_anti").select("kept_row.*")
