"""Quality rules on repetition, by suffix arrays of words.

The words of many texts are ordered together, the text being the first key, so each text has its own
suffix array inside one sort. Prefix doubling keeps the ranks of every level; climbing down the levels
gives the longest common prefix of neighbours. The LCP intervals at or above a length are the repeated
substrings; a suffix's own longest repeat is the larger of its two neighbours' values, and those that
cannot be prolonged to the left are the occurrences of maximal repeats. Their spans are united, and the
share of words in them and the longest of them are limited.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common

#: Base rule: words in repeated windows of 8 words, at most 30 %, and at least 20 words.
WINDOW, MOST_REPEATED_PERCENT, LEAST_WORDS = 8, 30, 20
#: The method's limits: share of words in repeats of 5 words and more, and length of the longest repeat.
SHORTEST, MOST_COVERED_PERCENT, LONGEST = 5, 40, 150
SYMBOLS = b"#*$%&|<>"


def suffix_order(symbols: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes, each text for itself, and the ranks by the first 1, 2, 4, ... symbols.

    Doubling stops when all suffixes are told apart; only suffixes still tied are sorted again.
    """
    n = len(symbols)
    keys = symbols ^ common._scramble(text_of.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    levels, width = [], 1
    sorted_keys = keys[order]
    head = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]) if n else np.zeros(0, dtype=bool)
    while True:
        first = np.maximum.accumulate(np.where(head, np.arange(n), 0)) if n else np.zeros(0, dtype=np.int64)
        ranks = np.full(n + 1, -1, dtype=np.int64)
        ranks[order] = first
        levels.append(ranks)
        tied = np.ones(n, dtype=bool)
        tied[:-1] &= head[:-1] & head[1:] if n else True
        if n:
            tied = ~(head & np.concatenate([head[1:], [True]]))
        places = np.flatnonzero(tied)
        if not len(places):
            return order, levels
        suffixes = order[places]
        ahead = suffixes + width
        inside = (ahead < n) & (text_of[np.minimum(ahead, n - 1)] == text_of[suffixes])
        second = np.where(inside, ranks[np.minimum(ahead, n)], -1) + 1
        combined = first[places] * (n + 2) + second
        again = np.argsort(combined, kind="stable")
        order[places] = suffixes[again]
        combined = combined[again]
        head = head.copy()
        head[places] = np.concatenate([[True], combined[1:] != combined[:-1]])
        width *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Longest common prefix of each suffix in order with the one before it (0 for the first)."""
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    left, right = order[:-1][pairs].copy(), order[1:][pairs].copy()
    length = np.zeros(len(pairs), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        step = np.where((ranks[left] == ranks[right]) & (ranks[left] >= 0), 1 << level, 0)
        left, right, length = np.minimum(left + step, n), np.minimum(right + step, n), length + step
    out[pairs + 1] = length
    return out


def longest_repeats(symbols: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest run of symbols from it that occurs again in its text."""
    order, levels = suffix_order(symbols, text_of)
    lcp = common_prefixes(order, levels)
    out = np.zeros(len(symbols), dtype=np.int64)
    if len(lcp):
        out[order] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    return out


def maximal_spans(repeats: np.ndarray, text_of: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the occurrences of maximal repeats of at least ``shortest`` symbols: those that
    are not the rest of the repeat one symbol before."""
    before = np.concatenate([[0], repeats[:-1]])
    same = np.concatenate([[False], text_of[1:] == text_of[:-1]]) if len(text_of) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero((repeats >= shortest) & ~(same & (before == repeats + 1)))
    return starts, starts + repeats[starts]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in the union of the spans."""
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of texts laid end to end as UTF-8."""
    n_texts = len(offsets) - 1
    starts, ends, text_of = common.words_of(data, offsets)
    repeats = longest_repeats(common.word_hashes(data, starts, ends), text_of)

    def per_text(flags: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=flags, minlength=n_texts).astype(np.int64)

    def bytes_per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)

    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    gap = np.zeros(256, dtype=bool)
    gap[[9, 10, 11, 12, 13, 32]] = True
    longest = np.zeros(n_texts, dtype=np.int64)
    np.maximum.at(longest, text_of, repeats)
    # lines: pieces between line feeds and the ends of texts
    breaks = np.flatnonzero(data == 10)
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    line_starts = np.concatenate([[0], line_ends[:-1] + (np.searchsorted(breaks, line_ends[:-1], side="right") > np.searchsorted(breaks, line_ends[:-1], side="left"))])
    line_starts = np.minimum(line_starts, line_ends)
    first_word = np.searchsorted(starts, line_starts)
    worded = (first_word < len(starts)) & (np.concatenate([starts, [0]])[first_word] < line_ends)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_text = np.searchsorted(offsets[1:], line_starts, side="right")
    line_keys = common.word_hashes(data, line_starts, line_ends) ^ common._scramble(line_text.astype(np.uint64) + np.uint64(1))
    _, kept = np.unique(line_keys, return_index=True)
    return {
        "n_words": np.bincount(text_of, minlength=n_texts).astype(np.int64),
        "word_chars": bytes_per_text(((data & 0xC0) != 0x80) & ~gap[data]),
        "n_symbols": bytes_per_text(symbol[data]),
        "n_dup_lines": np.bincount(line_text, minlength=n_texts) - np.bincount(line_text[kept], minlength=n_texts),
        "n_repeat_words": per_text(covered(*maximal_spans(repeats, text_of, WINDOW), len(repeats)), text_of),
        "n_covered": per_text(covered(*maximal_spans(repeats, text_of, SHORTEST), len(repeats)), text_of),
        "longest_repeat": longest,
    }


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]


def repetition(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row; a null or empty text has zeros. One pass, no shuffle.

    Memory of a task: about 3 MB of text at a time, or one text if it is longer.
    """

    def measure(batches):
        for batch in common.batches_of(batches):
            found = measures(*common.joined_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=["doc_id", *MEASURES])

    return common.texts(docs).mapInArrow(measure, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The measures, ``base_failed``, and ``kept``: base rules and the limits on repeats both hold."""
    bad = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    good = (100 * F.col("n_covered") <= MOST_COVERED_PERCENT * F.col("n_words")) & (F.col("longest_repeat") <= LONGEST)
    return repetition(docs).withColumn("base_failed", bad).withColumn("kept", ~bad & good)
