"""N-gram Jaccard join by Bayesian candidate pruning.

Texts are sets of five-word shingles; equal sets are copies and go on as one. Bands of MinHash values name
candidates. Two candidates' values are compared a few at a time, and a pair is dropped as soon as the
posterior probability that its similarity reaches the threshold, given the matches so far and a uniform
prior, falls below ``TOLERANCE``. What is never dropped is verified on the sets themselves.

First the buckets of the bands are pruned by MinHash values alone; the pairs left connect texts into small
groups. Then the sets of a group meet, all its pairs are pruned and verified, and links are counted. Large
buckets and groups are cut into blocks by a hash, and each pair of blocks is a piece of work of bounded
size that sends back one row per text, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.llm.graph import components
from quillmill.session import written

WORDS = 5
#: The threshold 0.8 as a fraction: shared / all >= 4 / 5.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, ROWS, STEP = 24, 4, 16
VALUES = BANDS * ROWS
TOLERANCE = 1e-6
#: Texts of a block; a piece of work holds two.
BLOCK = 256

_MULTIPLY = common._mix(31, VALUES)
_ADD = common._mix(32, VALUES)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of texts laid end to end, in order, and the n + 1 offsets of the texts in them.

    A text of fewer words than a shingle has is one shingle; a text without words has none.
    """
    starts, ends, text_of = common.words_of(data, offsets)
    words = common.word_hashes(data, starts, ends)
    n_texts = len(offsets) - 1
    counts = np.bincount(text_of, minlength=n_texts)
    rolled = np.zeros(len(words) + WORDS, dtype=np.uint64)
    for k in range(WORDS):
        rolled[: len(words)] = rolled[: len(words)] * common._STEP + np.append(words, np.zeros(WORDS, dtype=np.uint64))[k : k + len(words)]
    rest = np.cumsum(counts)[text_of] - np.arange(len(words)) if len(words) else text_of
    full = rest >= WORDS
    begin = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    extra = np.array([hash_of_few(words[begin[t] : begin[t] + counts[t]]) for t in short.tolist()], dtype=np.uint64)
    value = np.concatenate([common._scramble(rolled[: len(words)][full]), extra])
    owner = np.concatenate([text_of[full], short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]) if len(value) else np.zeros(0, dtype=bool)
    return value[new], np.searchsorted(owner[new], np.arange(n_texts + 1))


def hash_of_few(words: np.ndarray) -> int:
    h = np.zeros(1, dtype=np.uint64)
    for w in words:
        h = common._scramble(h * common._STEP + w)
    return int(h[0])


def signatures(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values [texts, VALUES] as 32-bit numbers; a text without shingles has the largest throughout."""
    out = np.full((len(offsets) - 1, VALUES), np.uint32(0xFFFFFFFF))
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        for k in range(VALUES):
            mixed = value * _MULTIPLY[k] + _ADD[k]
            out[some, k] = np.minimum.reduceat((mixed >> np.uint64(32)).astype(np.uint32), offsets[some])
    return out


def posterior(matches: int, compared: int, threshold: float = NUMERATOR / DENOMINATOR) -> float:
    """P(similarity >= threshold | matches of compared values agree), uniform prior: the upper tail of
    Beta(matches + 1, compared - matches + 1), which is a sum of binomial terms."""
    n = compared + 1
    return sum(comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(matches + 1))


def least_matches(tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, fewest matches at which a pair goes on)."""
    out = []
    for compared in range(STEP, VALUES + 1, STEP):
        out.append((compared, next(m for m in range(compared + 1) if posterior(m, compared) >= tolerance)))
    return out


_NEEDED = least_matches()


def pruned(signature: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are never dropped. Sizes too far apart cannot reach the threshold."""
    a, b = size[i], size[j]
    near = (NUMERATOR * np.maximum(a, b) <= DENOMINATOR * np.minimum(a, b)) & (a > 0)
    i, j = i[near], j[near]
    matches = np.zeros(len(i), dtype=np.int64)
    for compared, needed in _NEEDED:
        part = slice(compared - STEP, compared)
        matches += (signature[i, part] == signature[j, part]).sum(axis=1)
        on = matches >= needed
        i, j, matches = i[on], j[on], matches[on]
    return i, j


def pairs(group: np.ndarray, side: np.ndarray, one_block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of equal ``group`` (rows lie in its order), a distance at a time. Where a group joins two
    blocks, only pairs of rows from different sides."""
    for distance in range(1, len(group)):
        i = np.flatnonzero(group[distance:] == group[:-distance])
        if not len(i):
            return
        j = i + distance
        on = one_block[i] | (side[i] != side[j])
        yield i[on], j[on]


def unite(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each of ``n`` rows is connected to by the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (before == root).all():
            break
    return root


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, ``set`` (128-bit name of the shingle set, null if empty), ``signature``."""

    def sketch(batches):
        for batch in common.batches_of(batches):
            value, offsets = shingles(*common.joined_bytes(batch.column("text")))
            found = signatures(value, offsets)
            parts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            names = [hashlib.md5(value[a:b].tobytes()).digest() if b > a else None for a, b in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(np.diff(offsets), pa.int64()), pa.array(names, pa.binary()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                names=["doc_id", "row_key", "n_shingles", "set", "signature"],
            )

    rows = common.texts(docs).withColumn("row_key", common.row_key())
    return rows.mapInArrow(sketch, "doc_id bigint, row_key bigint, n_shingles bigint, set binary, signature binary")


def _runs(batches, keys: list[str]):
    """Arrow batches in the order of ``keys``, cut so that no run of equal keys is parted."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        number = _numbers(table, keys)
        last = int(np.searchsorted(number, number[-1]))
        if last:
            yield table.slice(0, last), number[:last]
        kept = table.slice(last)
    if kept is not None:
        yield kept, _numbers(kept, keys)


def _numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _signature_rows(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, VALUES)


def _in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows once per pair of blocks (low, high) that theirs is in; ``side`` is their block. Wants ``n``, the
    number of rows of the key. Work comes in the order of key and pair, each pair in one task."""
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = rows.withColumn("blocks", n_blocks).withColumn("side", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = spread.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")).drop("other", "blocks", "n")
    order = [key, "low", "high"]
    return work.repartition(*order).sortWithinPartitions(*order, "set")


def candidate_links(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all texts whose pair is never dropped: from each piece of work, one per text."""
    bands = sets.select("set", F.posexplode(_band_keys()).alias("band", "values")).select("set", F.xxhash64("band", "values").alias("bucket"))
    held = bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = bands.join(held, "bucket").groupBy("set").agg(F.collect_list(F.struct("bucket", "n")).alias("buckets"))  # BANDS at most
    rows = met.join(sets.select("set", "n_shingles", "signature"), "set").select("set", "n_shingles", "signature", F.explode("buckets").alias("b"))
    work = _in_blocks(rows.select("set", "n_shingles", "signature", "b.bucket", "b.n"), "bucket")

    def prune(batches):
        for table, number in _runs(batches, ["bucket", "low", "high"]):
            signature, size = _signature_rows(table), table.column("n_shingles").to_numpy()
            names = np.array(table.column("set").to_pylist(), dtype=object)
            one = table.column("low").to_numpy() == table.column("high").to_numpy()
            left, right = [], []
            for i, j in pairs(number, table.column("side").to_numpy(), one):
                i, j = pruned(signature, size, i, j)
                left.append(i)
                right.append(j)
            if not left:
                continue
            root = unite(len(names), np.concatenate(left), np.concatenate(right))
            hung = np.flatnonzero(root != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(names[root[hung]], pa.binary()), pa.array(names[hung], pa.binary())], names=["a", "b"])

    return work.select("bucket", "low", "high", "side", "set", "n_shingles", "signature").mapInArrow(prune, "a binary, b binary")


def _band_keys():
    """The band values as pieces of the signature's bytes."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.substr(F.col("signature"), k * (4 * ROWS) + 1, F.lit(4 * ROWS)))


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """For the texts of ``groups`` (node, root): set, links (pairs verified in a piece of work), and ``to``, the
    least text of the piece that it is connected to."""
    n = groups.groupBy("root").agg(F.count("*").alias("n"))
    members = groups.join(n, "root").select(F.col("node").alias("set"), F.col("root").alias("grp"), "n")
    wanted = members.join(sets.select("set", "doc_id", "row_key"), "set").withColumnsRenamed({"doc_id": "d", "row_key": "r"})
    texts = common.texts(docs).withColumn("row_key", common.row_key())
    met = texts.join(wanted, (F.col("row_key") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")))
    # rows that repeat the representative's id and text bring the same set again
    rows = met.select("set", "grp", "n", "text")

    def read(batches):
        for batch in common.batches_of(batches):
            value, offsets = shingles(*common.joined_bytes(batch.column("text")))
            parts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            held = [batch.column(c) for c in ("set", "grp", "n")]
            members = pa.array([value[a:b].tobytes() for a, b in parts], pa.binary())
            marks = pa.array([s.tobytes() for s in signatures(value, offsets)], pa.binary())
            yield pa.RecordBatch.from_arrays([*held, members, marks], names=["set", "grp", "n", "members", "signature"])

    work = _in_blocks(rows.mapInArrow(read, "set binary, grp binary, n bigint, members binary, signature binary"), "grp")

    def verify(batches):
        for table, number in _runs(batches, ["grp", "low", "high"]):
            names = np.array(table.column("set").to_pylist(), dtype=object)
            first = np.concatenate([[True], (names[1:] != names[:-1]) | (number[1:] != number[:-1])])
            table, number, names = table.filter(pa.array(first)), number[first], names[first]
            held = [np.frombuffer(m, dtype=np.uint64) for m in table.column("members").to_pylist()]
            size = np.array([len(h) for h in held])
            signature = _signature_rows(table)
            one = table.column("low").to_numpy() == table.column("high").to_numpy()
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in pairs(number, table.column("side").to_numpy(), one):
                i, j = pruned(signature, size, i, j)
                left.append(i)
                right.append(j)
            i, j = np.concatenate(left), np.concatenate(right)
            good = same_enough(held, i, j)
            i, j = i[good], j[good]
            root = unite(len(names), i, j)
            links = np.bincount(i, minlength=len(names)) + np.bincount(j, minlength=len(names))
            on = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[on], pa.binary()), pa.array(links[on], pa.int64()), pa.array(names[root[on]], pa.binary())], names=["set", "links", "to"]
            )

    return work.select("grp", "low", "high", "side", "set", "members", "signature").mapInArrow(verify, "set binary, links bigint, to binary")


def same_enough(held: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair of sets reaches the threshold exactly. One set is marked at a time, and all its
    partners are counted against the marks together."""
    out = np.zeros(len(i), dtype=bool)
    if not len(i):
        return out
    used = np.unique(np.concatenate([i, j]))
    _, number = np.unique(np.concatenate([held[k] for k in used]), return_inverse=True)
    cuts = np.cumsum([len(held[k]) for k in used])
    own = dict(zip(used.tolist(), np.split(number, cuts[:-1]), strict=True))
    marks = np.zeros(int(number.max()) + 1, dtype=np.int64)
    order = np.argsort(i, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
        a = own[int(i[part[0]])]
        marks[a] = 1
        others = [own[k] for k in j[part].tolist()]
        sizes = np.array([len(o) for o in others])
        shared = np.add.reduceat(marks[np.concatenate(others)], np.cumsum(sizes) - sizes)
        marks[a] = 0
        out[part] = DENOMINATOR * shared >= NUMERATOR * (len(a) + sizes - shared)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, class_id, class_key, n_links, n_copies.

    Rows are of one class if a chain of links connects them; a link is a Jaccard similarity of at least 0.8.
    class_id is the least doc_id of the class (null if all are null); rows that share an id but not a text may be of several
    classes, so class_key, which no two classes share, tells classes apart (null for a text without words). n_links counts the other shingle sets
    that are linked to the row's own, n_copies the rows that have its set, itself among them. A text
    without words has no links and no copies; its class is its own.
    """
    held = written(sketches(docs), "sketches")
    some = held.filter(F.col("set").isNotNull())
    first = F.min(F.struct("doc_id", "row_key"))
    sets = written(
        some.groupBy("set").agg(first.alias("first"), F.count("*").alias("n_copies"), F.min("doc_id").alias("least"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature"))
        .select("set", "first.doc_id", "first.row_key", "n_copies", "least", "n_shingles", "signature"),
        "shingle-sets",
    )
    groups = components(candidate_links(sets), "candidate-groups")
    links = written(verified_links(docs, sets, groups), "verified-links")
    classes = components(links.select(F.col("set").alias("a"), F.col("to").alias("b")), "near-classes").withColumnRenamed("node", "set")
    counted = links.groupBy("set").agg(F.sum("links").alias("n_links"))
    named = sets.select("set", "n_copies", "least").join(classes, "set", "left").withColumn("root", F.coalesce("root", "set"))
    ids = named.groupBy("root").agg(F.min("least").alias("class_id"))
    known = named.join(ids, "root").join(counted, "set", "left").select(
        "set", "class_id", F.lower(F.hex("root")).alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    full = some.select("doc_id", "row_key", "set").join(known, "set").select("doc_id", "row_key", "class_id", "class_key", "n_links", "n_copies")
    empty = held.filter(F.col("set").isNull())
    alone = empty.select("doc_id", "row_key", F.col("doc_id").alias("class_id"), F.lit(None).cast("string").alias("class_key"), F.lit(0).cast("bigint").alias("n_links"), F.lit(1).cast("bigint").alias("n_copies"))
    return full.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least id (ties: least
    hash of the text, then the other columns). Texts without words all stay."""
    classes = near_duplicates(docs)
    linked = classes.filter("n_links > 0 or n_copies > 1").select("doc_id", "row_key", "class_key")
    best = linked.groupBy("class_key").agg(F.min(F.struct("doc_id", "row_key")).alias("best"))
    # rows to leave out, and of the best rows of a class all but the first if they repeat
    rest = linked.join(best, "class_key").select("doc_id", "row_key", (F.struct("doc_id", "row_key") == F.col("best")).alias("is_best")).distinct()
    rows = common.packed(docs)
    met = rows.join(rest, common.same_row(rows, rest), "left").select("kept_row", rows["doc_id"], rows["row_key"], "is_best")
    again = Window.partitionBy("row_key", "doc_id").orderBy(F.to_json("kept_row"))
    firsts = met.filter("is_best").withColumn("nth", F.row_number().over(again)).filter("nth = 1")
    return met.filter("is_best is null").select("kept_row").unionByName(firsts.select("kept_row")).select("kept_row.*")
