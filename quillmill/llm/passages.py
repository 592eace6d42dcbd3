"""Dedup of passages by hash buckets over the corpus, in place of a suffix array.

Only the first ``LENGTH`` bytes of a suffix count, so a suffix is a window. Windows are not ordered: they
are bucketed by hashes, called digits here, and whatever is alone after a digit leaves:

1. The first digit is an anchor: of the 16-byte strings in a window, the one with the least hash. Windows
   that are equal have equal anchors, so this bucket sort keeps equal windows together, and consecutive
   windows share an anchor, which makes some 6 rows of 100 windows.
2. The second digit is the whole stretch of windows of one anchor: where stretches are equal, all their
   windows are. Of each kind of stretch the smallest document stands for all; the others lose it whole.
   Different stretches of one anchor go on only if they agree 17 bytes beyond it on either side, as equal
   windows must.
3. The last digit is the window itself, for the stretches that go on.

Texts stay where they are: they lie in a bucketed table in blocks of about 8 MB. In each pass every block
sends each different digit once, with its smallest document, to the bucket of that digit's leading bits,
and gets one answer of a few bits per digit back, in the order of its questions. So no key is hot, however
many documents share it. With its questions a block sends a note to itself, from which the next pass goes on:
anchors are looked for once, and only what goes on is hashed again. Digits are compared by hashes of 112 bits (48 of the anchor, 64 of the rest).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.session import written

LENGTH, GRAM = 50, 16
SIDE = (LENGTH - GRAM) // 2
#: Bytes of text in a block; a task holds one block, and the questions that it asks.
BLOCK_BYTES = 8_000_000
#: Windows hashed at a time: what is made of them stays in a core's cache.
CHUNK = 32_768
#: Blocks whose digits come to as many as a bucket holds, in each pass. Each block sends a message to each bucket.
BLOCKS_A_BUCKET = 4
#: Buckets of the table of blocks; Spark allows 100 000, and there may be more blocks than that.
MAX_BUCKETS = 20_000
NO_DOC = np.iinfo(np.int64).max

_TABLE = common._mix(21, 256)
_STEP = int(common._mix(22, 1)[0])
_BACK = pow(_STEP, -1, 1 << 64)
_U = np.uint64


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 4 * LENGTH, _U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_FORTH, _BACKS = _powers(_STEP), _powers(_BACK)
_COMPRESS, _DECOMPRESS = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _sums(data: np.ndarray) -> np.ndarray:
    """Sums of the bytes' numbers times powers of the step, before each byte and after the last."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE.take(data) * _FORTH[: len(data)], out=out[1:])
    return out


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The stretches of windows with one anchor in texts laid end to end; they also part where a chunk begins.

    Per stretch: its first window's start, the place of its anchor, and 48 bits of the anchor's hash.
    """
    empty = np.zeros(0, dtype=np.int64)
    out = [(empty, empty, empty.astype(np.uint64))]
    # the last window starts of a text would run into the next one
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    long = ends - begins >= LENGTH
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[begins[long]] = 1
    edge[ends[long] - LENGTH + 1] = -1
    valid = np.cumsum(edge, dtype=np.int8).astype(bool)
    numbers, width = np.arange(CHUNK + LENGTH, dtype=np.uint64), LENGTH - GRAM + 1
    for a in range(0, len(data) - LENGTH + 1, CHUNK):
        own = valid[a : min(a + CHUNK, len(data) - LENGTH + 1)]
        sums = _sums(data[a : a + len(own) + LENGTH - 1])
        grams = sums[GRAM:] - sums[:-GRAM]
        grams *= _BACKS[: len(grams)]
        key = grams & _U(0xFFFFFFFF00000000)
        key |= numbers[: len(key)]
        reach = 1
        while 2 * reach <= width:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if reach < width:
            key = np.minimum(key[: -(width - reach)], key[width - reach :])
        place = key.astype(np.uint32)  # the least gram of each window, the leftmost of equals
        new = own.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~own[:-1]
        first = np.flatnonzero(new)
        anchor = place[first].astype(np.int64)
        out.append((first + a, anchor + a, _finished(grams[anchor], GRAM) >> _U(16)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _finished(sums: np.ndarray, size) -> np.ndarray:
    return common._scramble(sums + np.asarray(size).astype(np.uint64) * _U(_BACK))


def hashes(data: np.ndarray, *pieces: tuple[np.ndarray, np.ndarray | int]) -> list[np.ndarray]:
    """64-bit hashes of pieces of text, each given by starts in ascending order and sizes (or one size) of at most ``2 * LENGTH``."""
    out = [np.zeros(len(start), dtype=np.uint64) for start, _ in pieces]
    cuts = np.arange(0, len(data) + CHUNK, CHUNK)
    rows = [np.searchsorted(start, cuts) for start, _ in pieces]
    for k, a in enumerate(cuts[:-1].tolist()):
        if all(r[k] == r[k + 1] for r in rows):
            continue
        sums = _sums(data[a : a + CHUNK + 2 * LENGTH])
        for (start, size), r, found in zip(pieces, rows, out, strict=True):
            own = slice(r[k], r[k + 1])
            at, n = start[own] - a, size if isinstance(size, int) else size[own]
            found[own] = _finished((sums[at + n] - sums[at]) * _BACKS[at], n)
    return out


def _pressed(data: bytes) -> bytes:
    return _COMPRESS.compress(data)


def _pack(*columns: np.ndarray) -> bytes:
    return _pressed(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _planes(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` low bytes of 64-bit numbers, byte by byte, so that they pack well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :k].T


def _unpack(blob: bytes, n: int, *kinds: int | str) -> list[np.ndarray]:
    """Columns of ``n`` numbers: a type, or how many low bytes of 64-bit numbers were kept."""
    data, at, out = np.frombuffer(_DECOMPRESS.decompress(blob), np.uint8), 0, []
    for kind in kinds:
        size = n * (kind if isinstance(kind, int) else np.dtype(kind).itemsize)
        part = data[at : at + size]
        if isinstance(kind, int):
            whole = np.zeros((n, 8), dtype=np.uint8)
            whole[:, :kind] = part.reshape(kind, n).T
            out.append(whole.reshape(-1).view(np.uint64))
        else:
            out.append(part.view(kind))
        at += size
    return out


def _note(*columns: np.ndarray) -> bytes:
    """Columns of numbers below 2^32, of any lengths, byte by byte."""
    sizes = np.array([len(c) for c in columns], dtype=np.int64)
    return _pack(sizes, *(np.ascontiguousarray(c, dtype=np.uint32).view(np.uint8).reshape(-1, 4).T for c in columns))


def _from_note(blob: bytes, count: int) -> list[np.ndarray]:
    data = np.frombuffer(_DECOMPRESS.decompress(blob), np.uint8)
    ends = 8 * count + 4 * np.cumsum(data[: 8 * count].view(np.int64))
    parts = np.split(data[8 * count :], ends[:-1] - 8 * count)
    return [np.ascontiguousarray(p.reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64) for p in parts]


def _gaps(places: np.ndarray) -> np.ndarray:
    return np.diff(places, prepend=0)


def _runs(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` numbers from each of ``low`` on."""
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _least(doc: np.ndarray, *keys: np.ndarray):
    """Different keys in order, the least document of each, whether it has two, and each row's key number."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        row = k[order]
        new[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(new)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    d = doc[order]
    last = np.append(at[1:], len(order)) - 1 if len(order) else at
    return [k[order[at]] for k in keys], d[at], d[last] > d[at], number


def _bits(blobs: list[tuple[int, bytes]]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n) for n, b in blobs)]).astype(bool)


def _later(doc: np.ndarray, number: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
    """Rows of a key that a smaller document has, in the block or ``elsewhere``."""
    least = np.full(len(elsewhere), NO_DOC)
    np.minimum.at(least, number, doc)
    return elsewhere[number] | (doc > least[number])


class Block:
    """A block of documents. Each pass leaves a note of what the next ones need, so that none is done again."""

    def __init__(self, docs: pa.Table):
        order = np.argsort(np.array(docs.column("row_key").to_pylist(), dtype=np.int64), kind="stable")
        docs = docs.take(pa.array(order))
        self.ids = docs.column("doc_id").to_pylist()
        self.bodies = [_DECOMPRESS.decompress(b) for b in docs.column("body").to_pylist()]
        self.doc = np.array([NO_DOC if i is None else i for i in self.ids], dtype=np.int64)
        self.data = np.frombuffer(b"".join(self.bodies), dtype=np.uint8)
        self.ends = np.cumsum([len(b) for b in self.bodies]).astype(np.int64)

    def text(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, side="right")

    def ask_anchors(self):
        first, anchor, key = stretches(self.data, self.ends)
        (h,), _, several, _ = _least(self.doc[self.text(first)], key)
        return h, _note(_gaps(first), anchor - first), lambda a, b: (_planes(h[a:b], 6), np.packbits(several[a:b]))

    def take_anchors(self, note: bytes, blobs: list[tuple[int, bytes]]) -> None:
        gap, offset = _from_note(note, 2)
        first = np.cumsum(gap)
        anchor, text = first + offset, self.text(first)
        # each window is in a stretch, so one ends where the next begins, or with its text
        last = self.ends[text] - LENGTH
        same = np.flatnonzero(text[1:] == text[:-1])
        last[same] = first[same + 1] - 1
        h = hashes(self.data, (anchor, GRAM))[0] >> _U(16)
        on = _bits(blobs)[np.unique(h, return_inverse=True)[1]]
        self.first, self.last, self.anchor, self.h = first[on], last[on], anchor[on], h[on]

    def ask_stretches(self):
        first, last, anchor = self.first, self.last, self.anchor
        has = [np.flatnonzero(anchor - first >= SIDE), np.flatnonzero(last + LENGTH - anchor >= GRAM + SIDE)]
        begins = [anchor[has[0]] - SIDE, anchor[has[1]]]
        g, *sides = hashes(self.data, (first, last + LENGTH - first), *((b, GRAM + SIDE) for b in begins))
        left, right = np.zeros((2, len(first)), dtype=np.uint64)  # 32 bits; 0: not in the stretch
        for side, rows, found in zip((left, right), has, sides, strict=True):
            side[rows] = (found >> _U(32)) | _U(1)
        (h, g), least, _, number = _least(self.doc[self.text(first)], self.h, g)
        one = np.empty(len(h), dtype=np.int64)
        one[number] = np.arange(len(number))
        note = _note(_gaps(first), last - first, anchor - first, number)
        return h, note, lambda a, b: (
            _planes(h[a:b], 6), g[a:b], left[one[a:b]].astype(np.uint32), right[one[a:b]].astype(np.uint32), _planes(least[a:b], 8)
        )

    def take_stretches(self, note: bytes, blobs: list[tuple[int, bytes]]) -> None:
        gap, length, offset, number = _from_note(note, 4)
        first = np.cumsum(gap)
        last, anchor, d = first + length, first + offset, self.doc[self.text(first)]
        flags = np.concatenate([np.zeros(0, np.uint8), *(_unpack(b, n, "u1")[0] for n, b in blobs)])
        gone = _later(d, number, flags >= 4)
        sides = flags[number]
        self.gone = first[gone], last[gone] + LENGTH
        stays = ~gone & (sides > 0)
        first, last, anchor, sides = first[stays], last[stays], anchor[stays], sides[stays]
        # left of the middle for those that agree to the left, right of it for the others
        low = np.where(sides & 1, first, np.maximum(first, anchor - SIDE))
        high = np.where(sides & 2, last, np.minimum(last, anchor - SIDE))
        some = high >= low
        self.low, self.n, self.anchor = low[some], (high - low + 1)[some], anchor[some]

    def ask_windows(self):
        grams, x = hashes(self.data, (self.anchor, GRAM), (_runs(self.low, self.n), LENGTH))
        x >>= _U(16)
        # by the window and not its anchor: near copies have many windows of one anchor
        (x, grams), least, _, number = _least(np.repeat(self.doc[self.text(self.low)], self.n), x, np.repeat(grams, self.n))
        begin, end = self.gone
        note = _note(_gaps(begin), end - begin, _gaps(self.low), self.n, number)
        return x, note, lambda a, b: (_planes(x[a:b], 6), grams[a:b], _planes(least[a:b], 8))

    def take_windows(self, note: bytes, blobs: list[tuple[int, bytes]]) -> None:
        gap, size, low, n, number = _from_note(note, 5)
        low = np.cumsum(low)
        begin = np.cumsum(gap)
        start = _runs(low, n)[_later(np.repeat(self.doc[self.text(low)], n), number, _bits(blobs))]
        self.gone = np.concatenate([begin, start]), np.concatenate([begin + size, start + LENGTH])

    def results(self) -> dict[str, list]:
        order = np.argsort(self.gone[0], kind="stable")
        begin, end = (x[order] for x in self.gone)
        text, upto = self.text(begin), np.maximum.accumulate(end)
        new = np.flatnonzero(np.append(True, (begin[1:] > upto[:-1]) | (text[1:] != text[:-1]))[: len(begin)])
        begin, end, text = begin[new], upto[np.append(new[1:], len(order)) - 1] if len(new) else end, text[new]
        cuts = np.searchsorted(text, np.arange(len(self.bodies) + 1)).tolist()
        out = {"doc_id": self.ids, "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for k, (body, base) in enumerate(zip(self.bodies, self.ends.tolist(), strict=True)):
            base -= len(body)
            at, removed, kept = 0, 0, hashlib.sha256()
            for b, e in zip((begin[cuts[k] : cuts[k + 1]] - base).tolist(), (end[cuts[k] : cuts[k + 1]] - base).tolist(), strict=True):
                kept.update(body[at:b])
                at, removed = e, removed + e - b
            kept.update(body[at:])
            out["n_bytes"].append(len(body))
            out["n_removed"].append(removed)
            out["n_spans"].append(cuts[k + 1] - cuts[k])
            out["kept_sha256"].append(kept.hexdigest())
        return out


PASSES = ["anchors", "stretches", "windows"]


def _answer_anchors(sizes: list[int], blobs: list[bytes]) -> list[bytes]:
    """Which anchors two documents have: sent by two blocks, or by one that has it twice."""
    h, several = [], []
    for n, b in zip(sizes, blobs, strict=True):
        numbers, bits = _unpack(b, n, 6)[0], _DECOMPRESS.decompress(b)[6 * n :]
        h.append(numbers)
        several.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n))
    _, number, times = np.unique(np.concatenate(h), return_inverse=True, return_counts=True)
    shared = (times > 1) | (np.bincount(number, weights=np.concatenate(several)) > 0)
    return [np.packbits(x).tobytes() for x in np.split(shared[number], np.cumsum(sizes)[:-1])]


def _questions(sizes: list[int], blobs: list[bytes], *kinds: int | str) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*(_unpack(b, n, *kinds) for n, b in zip(sizes, blobs, strict=True)), strict=True)]


def _answer_stretches(sizes: list[int], blobs: list[bytes]) -> list[bytes]:
    """The sides on which another stretch of the anchor agrees (1 and 2), and if another block has a smaller document (4)."""
    h, g, left, right, doc = _questions(sizes, blobs, 6, "u8", "u4", "u4", 8)
    doc = doc.view(np.int64)
    (kind_h, _), least, _, number = _least(doc, h, g)
    one = np.empty(len(kind_h), dtype=np.int64)
    one[number] = np.arange(len(number))
    flags = np.zeros(len(kind_h), dtype=np.uint8)
    for bit, side in ((1, left[one]), (2, right[one])):
        has = np.flatnonzero(side > 0)
        _, _, _, same = _least(np.zeros(len(has), np.int64), kind_h[has], side[has])
        flags[has[np.bincount(same)[same] > 1] if len(has) else has] |= bit
    answers = flags[number] | (4 * (doc > least[number])).astype(np.uint8)
    return [_pack(x) for x in np.split(answers, np.cumsum(sizes)[:-1])]


def _answer_windows(sizes: list[int], blobs: list[bytes]) -> list[bytes]:
    """If another block has the window in a smaller document."""
    x, grams, doc = _questions(sizes, blobs, 6, "u8", 8)
    doc = doc.view(np.int64)
    _, least, _, number = _least(doc, x, grams)
    return [np.packbits(later).tobytes() for later in np.split(doc > least[number], np.cumsum(sizes)[:-1])]


_ANSWERS = {"anchors": _answer_anchors, "stretches": _answer_stretches, "windows": _answer_windows}
_ROWS = "bucket bigint, block bigint, n bigint, blob binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _advanced(docs: pa.Table, answers: pa.Table, k: int) -> Block:
    """The block after the first ``k`` passes, by the note and the answers of the last, which come in the order of its buckets."""
    block = Block(docs)
    if k and docs.num_rows:
        (_, _, note), *rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "blob")), strict=True), key=lambda r: r[0])
        getattr(block, f"take_{PASSES[k - 1]}")(note, [(n, b) for _, n, b in rows])
    return block


def _blocks(docs: DataFrame, size: int) -> tuple[str, int]:
    """The texts, packed, in a bucketed table by block; its name and the number of blocks."""
    spark = docs.sparkSession
    texts = common.texts(docs)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + int(total) // size)
    keyed = texts.withColumn("row_key", common.row_key())

    def pack(batches):
        for batch in common.batches_of(batches):
            bodies = [_pressed(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            held = [batch.column("doc_id"), batch.column("row_key"), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(held, names=["doc_id", "row_key", "body"])

    packed = keyed.mapInArrow(pack, "doc_id bigint, row_key bigint, body binary").withColumn("block", F.pmod("row_key", F.lit(n)))
    name = f"passages_{uuid.uuid4().hex}"
    # a bucket may hold several blocks, one after the other
    buckets = min(n, MAX_BUCKETS)
    packed.repartition(buckets, "block").write.bucketBy(buckets, "block").sortBy("block").format("parquet").saveAsTable(name)
    return name, n


def removed_passages(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: n_bytes, n_removed, n_spans and the hash of what is left.

    Removed is each byte of a ``LENGTH``-byte string that also starts in a document with a smaller id. A
    null text is empty; a null id counts as larger than all others; rows of one id do not remove each
    other's passages. No rows give no rows. The table of blocks is dropped at the end, also of a run that fails.
    """
    name, n_blocks = _blocks(docs, block_bytes)
    try:
        return _removed(docs.sparkSession, name, n_blocks)
    finally:
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _removed(spark: SparkSession, name: str, n_blocks: int) -> DataFrame:
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks // BLOCKS_A_BUCKET)
    answers = spark.createDataFrame([], _ROWS)

    def asker(k: int):
        def ask(docs: pa.Table, answers: pa.Table) -> pa.Table:
            h, note, columns = getattr(_advanced(docs, answers, k), f"ask_{PASSES[k]}")()
            bucket = (((h >> _U(16)) * _U(n_buckets)) >> _U(32)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(h) else np.zeros(0, np.int64)
            ends = np.append(cuts[1:], len(h)) if len(h) else cuts
            block = docs.column("block")[0].as_py()
            blobs = [note, *(_pack(*columns(a, b)) for a, b in zip(cuts.tolist(), ends.tolist(), strict=True))]
            # a block's note goes along in a bucket of its own
            return pa.table(
                {
                    "bucket": pa.array([-1 - block, *bucket[cuts].tolist()], pa.int64()), "block": pa.array([block] * len(blobs), pa.int64()),
                    "n": pa.array([0, *(ends - cuts).tolist()], pa.int64()), "blob": pa.array(blobs, pa.binary()),
                }
            )

        return ask

    def answerer(k: int):
        def answer(rows: pd.DataFrame) -> pd.DataFrame:
            if rows["bucket"].iloc[0] < 0:
                return rows
            sizes = rows["n"].tolist()
            return rows.assign(blob=_ANSWERS[PASSES[k]](sizes, rows["blob"].tolist()))

        return answer

    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = _advanced(docs, answers, len(PASSES)).results()
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    def with_blocks(answers: DataFrame):
        return spark.table(name).groupBy("block").cogroup(answers.groupBy("block"))

    for k, step in enumerate(PASSES):
        asked = with_blocks(answers).applyInArrow(asker(k), _ROWS)
        answers = written(asked.groupBy("bucket").applyInPandas(answerer(k), _ROWS), f"passages-{step}")
    return written(with_blocks(answers).applyInArrow(finish, RESULT), "passages")
