"""Titles that are nearly the same: all pairs of fitting length by marks and gram counts, edit distance, components.

Two titles are linked if their edit distance is at most ``1 - ratio`` of the longer one's length. One edit changes ``GRAM`` grams
at most, so near titles have nearly the same characters and grams. Titles are dealt out to blocks by length, and every two blocks
whose lengths fit are compared in one task, with a few machine words for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillmill.functions import text as tx
from quillmill.operators.components import component_labels
from quillmill.operators.dedupe import first_by_key
from quillmill.session import written

GRAM = 3
RATIO = 0.85

_EDGE = "\x02" * (GRAM - 1)

# Titles of a block: a share of all, so that small tables are dealt out as well, but no more than a task holds with ease
_SHARE = 64
_LEAST_ROWS, _MOST_ROWS = 500, 8_000
_MOST_CHARACTERS = 2_000_000

# Size of grams and number of kinds that they are counted in, for pairs that marks leave over: cheap first
_COUNTED = [(GRAM, 512), (GRAM, 2048), (5, 2048)]


def title_text(title: Column) -> Column:
    """What is compared: the lower-cased words of a title, one blank between them; NULL when there is no word."""
    words = tx.words(title)
    return F.when(F.size(words) > 0, F.array_join(words, " "))


# A text's marks are bits: for each of _BINS kinds of characters (code points modulo _BINS) the counts in _LEVELS that it
# reaches, and for each of _GRAM_BINS kinds of grams whether there is one
_BINS = 32
_LEVELS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 17, 21, 26, 33])
_GRAM_BINS = 512
_CHARACTER_MARKS = [f"mark{k}" for k in range(_BINS * len(_LEVELS) // 64)]
_GRAM_MARKS = [f"gram_mark{k}" for k in range(_GRAM_BINS // 64)]


@F.pandas_udf(StructType([StructField(c, LongType()) for c in _CHARACTER_MARKS + _GRAM_MARKS]))
def _marks(texts: pd.Series) -> pd.DataFrame:
    odd = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
    found = np.zeros((len(texts), len(_CHARACTER_MARKS + _GRAM_MARKS)), dtype=np.int64)
    for n, text in enumerate(texts):
        codes = np.frombuffer((_EDGE + text + _EDGE).encode("utf-32-le"), dtype=np.uint32)
        counts = np.bincount(codes[len(_EDGE):-len(_EDGE)] % _BINS, minlength=_BINS)
        mixed = sum(codes[k:len(codes) - GRAM + 1 + k] * odd[k] for k in range(GRAM))
        there = np.zeros(_GRAM_BINS, dtype=bool)
        there[(mixed >> np.uint32(16)) % _GRAM_BINS] = True
        found[n] = np.concatenate([np.packbits(counts[:, None] >= _LEVELS), np.packbits(there)]).view(np.int64)
    return pd.DataFrame(found, columns=_CHARACTER_MARKS + _GRAM_MARKS)


def _may_be_near(longer: str, shorter: str, edits: Column) -> Column:
    """Whether ``edits`` may do, by the texts' marks and lengths (columns with these prefixes); blocks are compared by the same rule.

    Counts of characters differ by at least the number of levels between them. An edit changes two counts by one, or one count and
    the length, so all differences and that of the lengths are at most twice the edits of a near pair. Likewise an edit
    takes away and brings no more than ``GRAM`` grams each.
    """
    differ = lambda marks: reduce(add, [F.bit_count(F.col(longer + c).bitwiseXOR(F.col(shorter + c))) for c in marks])
    lengths = F.col(longer + "length") - F.col(shorter + "length")
    return (differ(_GRAM_MARKS) <= edits * (2 * GRAM)) & (differ(_CHARACTER_MARKS) + lengths <= edits * 2)


def _allowed(length: float | np.ndarray, ratio: float) -> np.ndarray:
    """Edits that a pair may be apart whose longer title has this length."""
    return np.floor(np.asarray(length) * (1 - ratio) + 1e-9).astype(np.int64)


def _blocks(lengths: list[tuple[int, int]], ratio: float) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """From ``(length, titles)`` in order: ``(length, first block, parts)`` and ``(block, lowest, highest)``.

    Blocks follow the lengths; one has several lengths, or is one of the parts of a very common one. A block is compared with
    all from its ``lowest`` to itself, whose titles are no longer and may be near, so it is asked by those up to its ``highest``.
    """
    most = min(_MOST_ROWS, max(_LEAST_ROWS, sum(n for _, n in lengths) // _SHARE))
    dealt, spans, rows, characters = [], [], 0, 0
    for length, n in lengths:
        if not spans or rows + n > most or characters + n * length > _MOST_CHARACTERS:
            parts = max(1, -(-n // most), -(-n * length // _MOST_CHARACTERS))
            first = len(spans)
            spans += [(length, length)] * parts
            # what is left of a length dealt out to parts is no room for the next one
            rows, characters = (n, n * length) if parts == 1 else (most, _MOST_CHARACTERS)
        else:
            first, parts = len(spans) - 1, 1
            spans[first] = (spans[first][0], length)
            rows, characters = rows + n, characters + n * length
        dealt.append((length, first, parts))
    lowest, block = [], 0
    for least, _ in spans:
        while spans[block][1] < least - int(_allowed(least, ratio)):
            block += 1
        lowest.append(block)
    highest = [int(h) - 1 for h in np.searchsorted(lowest, np.arange(len(spans)), side="right")]
    return dealt, [(k, lowest[k], highest[k]) for k in range(len(spans))]


def _packed(titles: pd.DataFrame) -> pd.DataFrame:
    """A block as one row, in order of length: ids, lengths, marks (a row for each word of them) and all titles as one text."""
    titles = titles.sort_values("length", kind="stable")
    marks = titles[_CHARACTER_MARKS + _GRAM_MARKS].to_numpy(dtype=np.int64)
    return pd.DataFrame({
        "block": titles["block"].iloc[:1].to_numpy(), "ids": [titles["id"].tolist()], "lengths": [titles["length"].to_numpy(dtype=np.int64).tobytes()],
        "marks": [np.ascontiguousarray(marks.T).tobytes()], "text": ["".join(titles["text"])],
    })


class _Block:
    """A packed block, opened."""

    def __init__(self, ids: list, lengths: bytes, marks: bytes, text: str):
        self.ids, self.text = ids, text
        self.lengths = np.frombuffer(lengths, dtype=np.int64)
        self.marks = np.frombuffer(marks, dtype=np.uint64).reshape(-1, len(self.lengths))
        self.characters = (np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) % 251).astype(np.uint8)
        self.spans = [slice(end - length, end) for length, end in zip(self.lengths.tolist(), np.cumsum(self.lengths).tolist(), strict=True)]
        self.known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def counts(self, which: np.ndarray, size: int, kinds: int) -> np.ndarray:
        """How many grams of each kind these titles have; a title's are counted once."""
        if (size, kinds) not in self.known:
            self.known[size, kinds] = np.zeros((len(self.spans), kinds), dtype=np.int16), np.zeros(len(self.spans), dtype=bool)
        found, done = self.known[size, kinds]
        for k in np.unique(which[~done[which]]):
            text = self.characters[self.spans[k]].astype(np.uint64)
            mixed = np.zeros(max(len(text) - size + 1, 0), dtype=np.uint64)
            for at in range(size if len(mixed) else 0):
                mixed = mixed * np.uint64(256) + text[at:len(mixed) + at]
            mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            found[k] = np.minimum(np.bincount((mixed % np.uint64(kinds)).astype(np.int64), minlength=kinds), np.iinfo(np.int16).max)
            done[k] = True
        return found[which]


def _met(x: _Block, y: _Block, ratio: float, rows: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in two blocks, of which ``y`` has the longer titles, of the pairs that marks do not rule out, some rows at a time."""
    characters = len(_CHARACTER_MARKS)
    for start in range(0, len(y.lengths), rows):
        stop = min(start + rows, len(y.lengths))
        edits = _allowed(y.lengths[start:stop], ratio)[:, None]
        first = int(np.searchsorted(x.lengths, y.lengths[start] - edits[0, 0]))
        last = stop if x is y else len(x.lengths)
        differ = np.zeros((stop - start, last - first), dtype=np.uint16)
        for word in range(characters):
            differ += np.bitwise_count(y.marks[word, start:stop, None] ^ x.marks[word, None, first:last])
        shorter = y.lengths[start:stop, None] - x.lengths[None, first:last]
        may = (shorter <= edits) & (differ + shorter <= edits * 2)
        if x is y:  # of one block's titles the later one asks
            may &= np.arange(first, last)[None, :] < np.arange(start, stop)[:, None]
        j, i = np.nonzero(may)
        i, j = i + first, j + start
        differ = np.zeros(len(i), dtype=np.uint16)
        for word in range(characters, len(x.marks)):
            differ += np.bitwise_count(y.marks[word, j] ^ x.marks[word, i])
        near = differ <= _allowed(y.lengths[j], ratio) * (2 * GRAM)
        yield i[near], j[near]


def _counted(x: _Block, y: _Block, i: np.ndarray, j: np.ndarray, ratio: float, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that counts of grams leave over: an edit takes away and brings no more grams than their size.

    Marks tell whether a gram is there, which says little about long texts: these have them all, but not as often.
    """
    for size, kinds in _COUNTED:
        most, near = _allowed(y.lengths[j], ratio) * (2 * size), np.zeros(len(i), dtype=bool)
        for start in range(0, len(i), rows):
            some = slice(start, start + rows)
            differ = np.abs(x.counts(i[some], size, kinds) - y.counts(j[some], size, kinds))
            near[some] = differ.sum(axis=1, dtype=np.int64) <= most[some]
        i, j = i[near], j[near]
    return i, j


def _distance(one: str, other: str) -> int:
    """Edit distance: a column of the table is one integer, with a bit for each character (Myers)."""
    points = np.frombuffer(one.encode("utf-32-le"), dtype=np.uint32)
    where = {c: int.from_bytes(np.packbits(points == ord(c), bitorder="little").tobytes(), "little") for c in set(one)}
    full, last = (1 << len(one)) - 1, 1 << (len(one) - 1)
    up, down, distance = full, 0, len(one)
    for c in other:
        equal = where.get(c, 0)
        straight = equal | down
        equal = (((equal & up) + up) ^ up) | equal
        more, less = down | (full & ~(equal | up)), up & equal
        distance += bool(more & last) - bool(less & last)
        more, less = (more << 1) & full | 1, (less << 1) & full
        up, down = less | (full & ~(straight | more)), more & straight
    return distance


def _links(x: _Block, y: _Block, ratio: float) -> list[tuple[int, int]]:
    """Places in two blocks (or twice in one) of near pairs. Pairs that earlier ones connect are not compared."""
    shift = 0 if x is y else len(x.ids)
    groups, found = np.arange(shift + len(y.ids)), []
    for i, j in _met(x, y, ratio):
        apart = groups[i] != groups[j + shift]
        for a, b in zip(*_counted(x, y, i[apart], j[apart], ratio), strict=True):
            if groups[a] != groups[b + shift] and _distance(y.text[y.spans[b]], x.text[x.spans[a]]) <= _allowed(y.lengths[b], ratio):
                found.append((a, b))
                groups[groups == groups[b + shift]] = groups[a]
    return found


def _linking(ratio: float) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def links(key: tuple, asked: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or asking.empty:  # a part that no title fell to
            return pd.DataFrame({"id": [], "_id": []}, dtype=object)
        x = _Block(*asked.iloc[0][2:])
        y = x if key[0] == key[1] else _Block(*asking.iloc[0][2:])
        found = _links(x, y, ratio)
        return pd.DataFrame({"id": [x.ids[a] for a, _ in found], "_id": [y.ids[b] for _, b in found]})

    return links


def similar_links(texts: DataFrame, ratio: float = RATIO) -> DataFrame:
    """``(a, b)``, a < b: pairs of ``(id, text)`` rows within the ratio, which connect all that near pairs connect; texts are different.

    Every pair of fitting length is looked at, in tasks of two blocks. Their number grows with the square of the texts, the time for a
    pair is some 40 ns and what a task holds does not grow. A task leaves out pairs that its others connect, so a group of
    very many near titles gives a link for each of them and block, and not for each two.
    """
    spark, kind = texts.sparkSession, texts.schema["id"].dataType.simpleString()
    sized = texts.filter(F.col("id").isNotNull()).withColumn("length", F.length("text"))
    dealt, blocks = _blocks(sorted(tuple(r) for r in sized.groupBy("length").count().collect()), ratio)
    places = spark.createDataFrame(dealt, "length int, first int, parts int")
    titles = sized.join(F.broadcast(places), "length").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("text"), F.col("parts"))).cast("int"))
    marked = titles.select("block", "id", "text", "length", _marks("text").alias("_m")).select("block", "id", "text", "length", "_m.*")
    schema = f"block int, ids array<{kind}>, lengths binary, marks binary, text string"
    packed = marked.repartition(max(1, len(blocks)), "block").groupBy("block").applyInPandas(_packed, schema)
    partners = spark.createDataFrame(blocks, "block int, lowest int, highest int")
    held = written(packed, "title-blocks").join(F.broadcast(partners), "block")
    # tasks are dealt out by number, not by bytes: their work is in the pairs
    pairs = sum(k - lowest + 1 for k, lowest, _ in blocks)
    tasks = max(1, min(pairs, max(8 * spark.sparkContext.defaultParallelism, pairs // 4)))
    content = ["ids", "lengths", "marks", "text"]
    asked = held.select(F.col("block").alias("x"), F.explode(F.sequence("block", "highest")).alias("y"), *content)
    asking = held.select(
        F.explode(F.sequence("lowest", "block")).alias("x"), F.col("block").alias("y"), *[F.col(c).alias(f"_{c}") for c in content])
    sides = [side.repartition(tasks, "x", "y").groupBy("x", "y") for side in (asked, asking)]
    near = sides[0].cogroup(sides[1]).applyInPandas(_linking(ratio), f"id {kind}, _id {kind}")
    return near.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))


def merge_similar_titles(hits: DataFrame, order: str = "ord", ratio: float = RATIO) -> DataFrame:
    """First hit of each group of titles that a chain of near-equal titles connects; hits whose title has no word all stay.

    Equal titles are one before any are compared, however many copies there are. ``order`` is a number that tells hits apart.
    """
    keyed = hits.withColumn("_title", title_text(F.col("title")))
    titled = keyed.filter(F.col("_title").isNotNull())
    firsts = written(first_by_key(titled, ["_title"], [order]), "titles")
    texts = firsts.select(F.col(order).alias("id"), F.col("_title").alias("text"))
    labels = component_labels(similar_links(texts, ratio), "a", "b")
    # ids are orders: a group's label is its first hit, and all others of the group go
    later = labels.filter("node <> label").select(F.col("node").alias(order))
    kept = firsts.join(later, order, "left_anti").select(*keyed.columns)
    return kept.unionByName(keyed.filter(F.col("_title").isNull())).drop("_title")
