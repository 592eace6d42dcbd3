"""Page texts to clean text, chunks, sections, prompts, metadata and summaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from quillmill.functions import text as tx
from quillmill.operators.joins import frequent_first_lookup
from quillmill.operators.running import running_total
from quillmill.session import written

# Sizes, sections and prompts
CHUNK_CHARS = 4000
MAX_EMBED_CHARS = 30000
SECTIONS = {"title": (0, 200), "abstract": (200, 1000), "full_text": (0, MAX_EMBED_CHARS)}
WHOLE = "full_text"
MAX_SUMMARY_TOKENS = 500
PROMPTS = {
    "executive": ("gpt-4o", "Provide a concise executive summary of the following research paper:\n\n"),
    "key_findings": ("gpt-4o-mini", "List the key findings and conclusions from this research paper:\n\n"),
    "methodology": ("gpt-4o-mini", "Describe the methodology and experimental design of this research paper:\n\n"),
    "implications": ("gpt-4o-mini", "Discuss the implications and potential applications of this research:\n\n"),
}

# Words that mark a sentence as material for a kind of summary; "executive" takes any sentence
SUMMARY_CUES = {
    "executive": [],
    "key_findings": ["found", "finding", "findings", "result", "results", "showed", "shows", "conclude", "conclusion"],
    "methodology": ["method", "methods", "participants", "design", "randomized", "controlled", "measured", "sample"],
    "implications": ["implication", "implications", "suggest", "suggests", "future", "application", "applications"],
}

METADATA_SCHEMA = (
    "struct<keywords:array<string>,abstract:string,citations:int,publication_date:string,journal:string,"
    "authors:array<string>,institutions:array<string>,methodology:string,sample_size:int,duration:string>"
)


def split_empty(df: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with visible text, and rejects ``(stage, key, reason)`` of the others."""
    empty = F.col(text).isNull() | tx.is_blank(F.col(text))
    rejects = df.filter(empty).select(
        F.lit("parse").alias("stage"), F.col(key).cast("string").alias("key"), F.lit("empty_text").alias("reason")
    )
    return df.filter(~empty), rejects


def chunk_text(df: DataFrame, text: str, *keys: str, size: int = CHUNK_CHARS) -> DataFrame:
    """``(*keys, chunk_no, chunk)``: pieces of ``size`` characters without overlap; none for empty text."""
    return df.select(*keys, F.posexplode(tx.char_chunks(F.col(text), size))).select(
        *keys, F.col("pos").alias("chunk_no"), F.col("col").alias("chunk")
    )


def assemble_chunks(
    pages: DataFrame, doc: str, page_no: str, page_text: str, size: int = CHUNK_CHARS, range_pages: int = 1024
) -> DataFrame:
    """Page texts to ``(doc, chunk_no, chunk)`` of the assembled, cleaned document text.

    The same chunks as joining the pages in order, collapsing white space and cutting every
    ``size`` characters, but a document's pages never meet in one task: each page gets its
    character offset from a running total, is cut where chunks end, and the pieces meet
    again per chunk, which ``size`` bounds.
    """
    cleaned = pages.select(
        F.col(doc).alias(doc), F.col(page_no).cast("bigint").alias("_page"),
        tx.collapse_whitespace(F.coalesce(F.col(page_text), F.lit(""))).alias("_text"),
    ).filter(F.length("_text") > 0)
    spaced = F.length("_text").cast("bigint") + 1  # the blank between two pages
    placed = running_total(cleaned, spaced, "_page", "_start", by=(doc,), width=range_pages)
    # every page but the first opens with the blank that parts it from the one before
    body = F.when(F.col("_start") > 0, F.concat(F.lit(" "), F.col("_text"))).otherwise(F.col("_text"))
    begin = F.when(F.col("_start") > 0, F.col("_start") - 1).otherwise(F.lit(0))
    piece_source = placed.select(doc, "_page", body.alias("_body"), begin.alias("_begin"))
    # the first cut falls where the running chunk ends, the later ones every `size` characters
    room = (F.lit(size) - F.col("_begin") % size).cast("int")
    head = F.substring(F.col("_body"), F.lit(1), room)
    tail = tx.char_chunks(F.substring(F.col("_body"), room + 1, F.lit(2**31 - 1)), size)
    pieces = piece_source.select(
        doc, "_page", F.expr(f"_begin div {size}").alias("_first"), F.posexplode(F.concat(F.array(head), tail))
    ).select(doc, "_page", (F.col("_first") + F.col("pos")).alias("chunk_no"), F.col("col").alias("_piece"))
    grouped = pieces.groupBy(doc, "chunk_no").agg(F.array_sort(F.collect_list(F.struct("_page", "_piece"))).alias("_pieces"))
    return grouped.select(doc, "chunk_no", F.array_join(F.col("_pieces._piece"), "").alias("chunk"))


def text_parts(chunks: DataFrame, doc: str, chars: int = MAX_EMBED_CHARS, size: int = CHUNK_CHARS) -> DataFrame:
    """``(doc, part_no, text)``: each document's whole text in parts of ``chars`` characters, from its chunks.

    ``chars`` bounds what meets in one group: a chunk is cut where a part ends, and the pieces meet again by part.
    """
    begin = F.col("chunk_no").cast("bigint") * size
    room = (F.lit(chars) - begin % chars).cast("int")
    pieces = F.array(
        F.struct(F.expr(f"chunk_no * {size} div {chars}").cast("bigint").alias("part_no"), F.substring(F.col("chunk"), F.lit(1), room).alias("piece")),
        F.struct((F.expr(f"chunk_no * {size} div {chars}") + 1).cast("bigint").alias("part_no"), F.substring(F.col("chunk"), room + 1, F.lit(size)).alias("piece")),
    )
    cut = chunks.select(doc, "chunk_no", F.inline(pieces)).filter(F.length("piece") > 0)
    joined = cut.groupBy(doc, "part_no").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "piece"))).alias("_c"))
    return joined.select(doc, "part_no", F.array_join(F.col("_c.piece"), "").alias("text"))


def sections(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``(*keys, embedding_type, part_no, section_text)``: the positional sections, blank ones left out.

    ``full_text`` is the whole text, in parts of ``MAX_EMBED_CHARS`` characters, as long as an embedder takes.
    """
    parts = [
        F.struct(F.lit(name).alias("embedding_type"), F.lit(0).alias("part_no"), tx.char_slice(F.col(text), start, stop).alias("section_text"))
        for name, (start, stop) in SECTIONS.items() if name != WHOLE
    ]
    whole = F.transform(
        tx.char_chunks(F.col(text), MAX_EMBED_CHARS),
        lambda part, no: F.struct(F.lit(WHOLE).alias("embedding_type"), no.alias("part_no"), part.alias("section_text")),
    )
    return df.select(*keys, F.inline(F.concat(F.array(*parts), whole))).filter(~tx.is_blank(F.col("section_text")))


def prompts(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``(*keys, chunk_no, summary_type, model, prompt, max_tokens)``: every fixed instruction over each chunk of the text."""
    rows = F.array(*[
        F.struct(
            F.lit(kind).alias("summary_type"),
            F.lit(model).alias("model"),
            F.concat(F.lit(instruction), F.col("chunk")).alias("prompt"),
            F.lit(MAX_SUMMARY_TOKENS).alias("max_tokens"),
        )
        for kind, (model, instruction) in PROMPTS.items()
    ])
    return chunk_text(df, text, *keys).select(*keys, "chunk_no", F.inline(rows))


@F.arrow_udf(ArrayType(LongType()))
def _sentence_scores(sentence_words: pa.Array) -> pa.Array:
    """Per sentence, its words' mean count in the whole text, in thousandths; the words of a batch of texts in one pass."""
    in_text = pc.fill_null(pc.list_value_length(sentence_words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    sentences = sentence_words.flatten()
    sizes = pc.fill_null(pc.list_value_length(sentences), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    word = sentences.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.repeat(np.arange(len(in_text)), in_text), sizes)
    _, which, counts = np.unique(text * (word.max(initial=0) + 1) + word, return_inverse=True, return_counts=True)
    sums = np.concatenate([[0], np.cumsum(counts[which])])
    ends = np.cumsum(sizes)
    scores = (sums[ends] - sums[ends - sizes]) * 1000 // np.maximum(sizes, 1)
    offsets = np.concatenate([[0], np.cumsum(in_text)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores, pa.int64()), mask=sentence_words.is_null())


def extractive_summaries(df: DataFrame, text: str, *keys: str, top: int = 3) -> DataFrame:
    """``(*keys, summary_type, content)``: for each kind the ``top`` best sentences of the whole text, in document order.

    Sentences with a cue word of the kind come before others, then higher scores, then earlier
    ones. Everything happens inside the row: no sentence is sent anywhere. ``keys`` are carried along.
    """
    split = df.select(*keys, tx.sentences(F.col(text)).alias("_sentences"))
    worded = split.withColumn("_words", F.transform("_sentences", tx.words)).withColumn("_scores", _sentence_scores("_words"))
    every = F.transform(
        F.arrays_zip("_sentences", "_words", "_scores"),
        lambda s, no: F.struct(s["_words"].alias("words"), (-s["_scores"]).alias("minus"), no.alias("no"), s["_sentences"].alias("sentence")),
    )
    usable = worded.select(*keys, F.filter(every, lambda s: F.size(s["words"]) > 0).alias("_all"))

    def best(cues: list[str]) -> Column:
        def rank(s: Column) -> Column:
            other = ~F.arrays_overlap(s["words"], F.array(*map(F.lit, cues))) if cues else F.lit(True)
            return F.struct(other.alias("other"), s["minus"].alias("minus"), s["no"].alias("no"), s["sentence"].alias("sentence"))

        picked = F.slice(F.array_sort(F.transform("_all", rank)), 1, top)
        in_order = F.array_sort(F.transform(picked, lambda s: F.struct(s["no"].alias("no"), s["sentence"].alias("sentence"))))
        return F.array_join(F.transform(in_order, lambda s: s["sentence"]), " ")

    kinds = F.array(*[
        F.struct(F.lit(kind).alias("summary_type"), best(cues).alias("content")) for kind, cues in SUMMARY_CUES.items()
    ])
    # a filter on the size would be moved before the step that makes the array, and make it twice
    return usable.select(*keys, F.inline(F.when(F.size("_all") > 0, kinds)))


def keep_complete(summaries: DataFrame, key: str, wanted: int, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Summaries of documents that have all ``wanted`` kinds, and rejects of the others.

    ``among`` has the documents that were to be summarised: those without any summary are rejects as well.
    """
    usable = F.col("content").isNotNull() & (F.col("content") != "")
    complete = summaries.filter(usable).groupBy(key).agg(F.countDistinct("summary_type").alias("n"))
    complete = complete.filter(F.col("n") >= wanted).select(key)
    asked = (summaries if among is None else among).select(key).distinct()
    failed = asked.join(complete, key, "left_anti")
    rejects = failed.select(
        F.lit("summarise").alias("stage"), F.col(key).cast("string").alias("key"), F.lit("summary_failed").alias("reason")
    )
    return summaries.join(complete, key, "left_semi"), rejects


def keywords(df: DataFrame, text: str, key: str, top: int = 5, min_letters: int = 5) -> DataFrame:
    """``(key, rank, keyword, weight)``: the ``top`` words of each text by TF-IDF, ties alphabetically.

    ``weight`` is the count in the text times ln(texts / texts with the word).
    """
    every_word = tx.words(F.col(text))
    long_words = F.filter(every_word, lambda w: F.length(w) >= min_letters)
    counts = df.select(key, F.explode(long_words).alias("keyword")).groupBy(key, "keyword").agg(F.count(F.lit(1)).alias("tf"))
    # from each text's distinct words: the shuffle carries one row per word and task, not per word and text
    occurring = df.select(F.explode(F.array_distinct(long_words)).alias("keyword"))
    document_counts = occurring.groupBy("keyword").agg(F.count(F.lit(1)).alias("df"))
    texts = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    # a word of at least 1% of the texts: there are at most 100 times the mean distinct words of a text
    frequent = F.col("df") * 100 >= texts
    weight = F.round(F.col("tf") * F.ln(texts / F.col("df")), 9)
    weighted = frequent_first_lookup(counts, document_counts, "keyword", "df", frequent, key).withColumn("weight", weight)
    best = Window.partitionBy(key).orderBy(F.desc("weight"), "keyword")
    ranked = weighted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select(key, "rank", "keyword", "weight")


@F.arrow_udf(ArrayType(StringType()))
def _most_frequent(words: pa.Array, top: pa.Array) -> pa.Array:
    """Per text its ``top`` words by count, ties alphabetically; the words of a batch of texts in one pass."""
    in_text = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    # words by their place in the alphabet, which is that of their bytes as in Spark
    ordered = pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.empty(len(ordered), np.int64)
    place[ordered] = np.arange(len(ordered))
    size = max(len(ordered), 1)
    word = place[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
    pairs, n = np.unique(np.repeat(np.arange(len(in_text)), in_text) * size + word, return_counts=True)
    text = pairs // size
    best = np.lexsort((pairs, -n, text))  # texts stay where they are
    rank = np.arange(len(pairs)) - np.searchsorted(text, text)
    best = best[rank < top[0].as_py()] if len(top) else best
    offsets = np.searchsorted(text[best], np.arange(len(in_text) + 1)).astype(np.int32)
    chosen = coded.dictionary.take(pa.array(ordered[pairs[best] % size]))
    return pa.ListArray.from_arrays(pa.array(offsets), chosen)


def frequent_words(df: DataFrame, text: str, *keys: str, top: int = 5, min_letters: int = 5) -> DataFrame:
    """``(*keys, keywords)``: the ``top`` words of each text by count alone, ties alphabetically: for texts that come in batches.

    A text whose keys no other one has is counted inside its row; only texts that share their keys are counted together by a shuffle.
    """
    shared = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    # read back from a table, so that Spark sees how few there are and sends no text anywhere
    shared = written(shared.select(*[F.col(k).alias(f"_of_{k}") for k in keys]), "shared-keys")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    long_words = F.filter(tx.words(F.col(text)), lambda w: F.length(w) >= min_letters)
    # asked of the text: a filter on the words or the result would have Spark make them twice
    worded = F.rlike(F.lower(F.col(text)), F.lit(tx.run_of_letters(min_letters)))
    alone = df.filter(worded).join(shared, same, "left_anti").select(*keys, _most_frequent(long_words, F.lit(top)).alias("keywords"))
    together = df.join(shared, same, "left_semi").select(*keys, F.explode(long_words).alias("word"))
    counts = together.groupBy(*keys, "word").agg(F.count("*").alias("n"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    in_order = F.array_sort(F.collect_list(F.struct("rank", "word")))
    merged = ranked.groupBy(*keys).agg(F.transform(in_order, lambda w: w["word"]).alias("keywords"))
    return alone.unionByName(merged)


def _found(text: Column, pattern: str) -> Column:
    match = F.regexp_extract(text, pattern, 1)
    return F.when(match != "", match)


def _found_all(text: Column, pattern: str) -> Column:
    matches = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.when(F.size(matches) > 0, matches)


def _found_number(text: Column, pattern: str) -> Column:
    return F.replace(_found(text, pattern), F.lit(",")).try_cast("int")


# What is looked for in a text, by field of the metadata
METADATA_PATTERNS = {
    "abstract": r"(?i)\babstract\s*[:.]\s*([^\n]+)",
    "citations": r"(?i)\bcited\s+by\s+([0-9][0-9,]*)",
    "publication_date": r"\b((?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9])\b",
    "journal": r"\b((?:International )?Journal of [A-Z][a-z]+(?: [A-Z][a-z]+)*)",
    "authors": r"(?m)^[Aa]uthors?\s*:\s*([^\n]+)$",
    "institutions": r"\b((?:University|Institute) of [A-Z][a-z]+(?: [A-Z][a-z]+)*)",
    "methodology": r"(?i)\b(randomi[sz]ed controlled trial|cohort study|case-control study|meta-analysis|systematic review)\b",
    "sample_size": r"(?i)\b([0-9][0-9,]*)\s+(?:participants|subjects|patients)\b",
    "duration": r"(?i)\b([0-9]+\s+(?:day|week|month|year)s?)\b",
}
_LIST_FIELDS = ("authors", "institutions")
_NUMBER_FIELDS = ("citations", "sample_size")


def metadata_fields(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``(*keys, <field>…)``: what the patterns find in the whole text, NULL where nothing is found."""
    columns = []
    for field, pattern in METADATA_PATTERNS.items():
        find = _found_all if field in _LIST_FIELDS else _found_number if field in _NUMBER_FIELDS else _found
        columns.append(find(F.col(text), pattern).alias(field))
    return df.select(*keys, *columns)


def extract_metadata(df: DataFrame, text: str, key: str) -> DataFrame:
    """``(key, metadata)`` with all ten fields, keywords included."""
    words = keywords(df, text, key).groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda k: k["keyword"]).alias("keywords")
    )
    found = metadata_fields(df, text, key).join(words, key, "left")
    return found.select(key, F.struct("keywords", *METADATA_PATTERNS).cast(METADATA_SCHEMA).alias("metadata"))


def json_value(value: Column) -> Column:
    """One value of any type as JSON text; NULL stays NULL."""
    wrapped = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(wrapped, F.lit(2), F.length(wrapped) - 2))


def metadata_rows(extracted: DataFrame, key: str) -> DataFrame:
    """``(paper_id, key, value)`` rows with JSON values, one per field that was found."""
    names = ["keywords", *METADATA_PATTERNS]
    rows = F.array(*[
        F.struct(F.lit(name).alias("key"), json_value(F.col(f"metadata.{name}")).alias("value")) for name in names
    ])
    flat = extracted.select(F.col(key).alias("paper_id"), F.inline(rows))
    return flat.filter(F.col("value").isNotNull())
