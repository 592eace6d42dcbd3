"""SentencePiece encoding and decoding in the model file's own mode (BPE), and best sums by a max-plus scan.

The ids are those of the file's mode: characters are merged pair by pair, the pair whose piece has the highest
score first, the leftmost of equal ones; characters without a piece are spelled in byte pieces. No piece lies
across two characters that stand side by side in no piece, so a text falls apart there (before every mark of
space that follows another character, and at many places more) and equal parts are merged once. A chunk of a
giant text merges the parts that begin in it; the part across a cut is handed over whole to the chunk it
begins in, so chunks and short texts agree.

``score`` is another figure: the largest sum of scores that any path of pieces over the text has (a character
without a piece counts the lowest score and a penalty). A max-plus scan finds it, and its path is that of
SentencePiece's unigram mode, not of BPE: scores of a BPE file are merge ranks and do not add up to its choice.
At a cut of a giant text the state is how many characters of the next chunk the crossing piece has taken, so a
chunk is a matrix of best sums from each state at its start to each state at its end. Matrices multiply in the
max-plus sense, which is associative: blocks of chunks are multiplied apart, then the blocks of a text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, islice
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.session import written

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of a chunk; texts up to this long are one chunk. Chunks of a block, which is multiplied by one task.
CHUNK, BLOCK = 1 << 16, 256
#: Added to the lowest score for a character that has no piece (the library's value).
UNKNOWN_PENALTY = -10.0
_B = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Characters up to which pairs are looked through in place of kept in a heap.
SHORT = 64
NEVER = -np.inf


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores as plain lists, so that tasks need no model file."""

    pieces: list[str]
    scores: list[float]
    ordinary: list[bool]
    byte_ids: list[int]

    @staticmethod
    def read(path: str = MODEL_PATH) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in ids]
        pieces = [sp.id_to_piece(i) for i in ids]
        by_name = {p: i for i, p in enumerate(pieces) if sp.is_byte(i)}
        return Vocabulary(pieces, [sp.get_score(i) for i in ids], [not s for s in special], [by_name[f"<0x{b:02X}>"] for b in range(256)])

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p, o in zip(self.pieces, self.ordinary, strict=True) if o), default=1)

    @cached_property
    def unknown_score(self) -> float:
        return min((s for s, o in zip(self.scores, self.ordinary, strict=True) if o), default=0.0) + UNKNOWN_PENALTY

    @cached_property
    def parts_at_spaces(self) -> bool:
        """Whether no piece has a mark of space behind another character."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, o in zip(self.pieces, self.ordinary, strict=True) if o)

    @cached_property
    def number(self) -> dict[str, int]:
        """Id of every piece that merges can make."""
        return {p: i for i, (p, o) in enumerate(zip(self.pieces, self.ordinary, strict=True)) if o}

    @cached_property
    def rank(self) -> dict[str, float]:
        """Score of every piece that merges can make: the highest goes first."""
        return {p: self.scores[i] for p, i in self.number.items()}

    @cached_property
    def pairs(self) -> set[str]:
        """Characters that stand side by side in some piece."""
        return {p[k : k + 2] for p in self.number for k in range(len(p) - 1)}

    def next_cut(self, text: str, at: int) -> int:
        """The first place from ``at`` on that no piece can lie across; the ends of the text are such places."""
        while 0 < at < len(text) and text[at - 1 : at + 1] in self.pairs:
            at += 1
        return at

    @cached_property
    def weights(self) -> np.ndarray:
        """Scores by id; the last, for id -1, is that of no piece."""
        return np.append(np.array(self.scores), NEVER)

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the pieces, their ids, and which leading 20 bits any of them has."""
        ids = np.array([i for i, o in enumerate(self.ordinary) if o], dtype=np.int64)
        hashes = np.zeros(len(ids), dtype=np.uint64)
        for k, i in enumerate(ids):
            h = np.zeros(1, dtype=np.uint64)
            for c in self.pieces[i]:
                h = h * _B + np.uint64(ord(c) + 1)
            hashes[k] = common._scramble(h)[0]
        order = np.argsort(hashes)
        lead = np.zeros(1 << 20, dtype=bool)
        lead[(hashes >> np.uint64(44)).astype(np.int64)] = True
        return hashes[order], ids[order], lead

    @cached_property
    def spelled(self) -> list[bytes]:
        """The bytes that each piece stands for."""
        out = [p.replace(SPACE, " ").encode() if o else b"" for p, o in zip(self.pieces, self.ordinary, strict=True)]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        known, ids, lead = self.table
        out = np.full(hashes.shape, -1, dtype=np.int32)
        may = np.nonzero(lead[(hashes >> np.uint64(44)).astype(np.int64)])
        wanted = hashes[may]
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        out[may] = np.where(known[at] == wanted, ids[at], -1)
        return out


def normalised(text: str) -> str:
    """Spaces as marks, and one mark in front; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def segments(text: str, vocabulary: Vocabulary) -> list[str]:
    """The parts between which no piece can lie."""
    return _SEGMENT.findall(text) if vocabulary.parts_at_spaces else ([text] if text else [])


def _merged_short(rank: dict[str, float], parts: list[str]) -> list[str]:
    """Pair by pair by looking through all pairs each time: the faster way for a word."""
    get = rank.get
    worth = [get(pair, NEVER) for pair in map(add, parts, parts[1:])]
    while worth and (best := max(worth)) > NEVER:
        i = worth.index(best)  # the leftmost of equal ones
        parts[i] += parts.pop(i + 1)
        del worth[i]
        if i < len(worth):
            worth[i] = get(parts[i] + parts[i + 1], NEVER)
        if i:
            worth[i - 1] = get(parts[i - 1] + parts[i], NEVER)
    return parts


def _merged_long(rank: dict[str, float], parts: list[str]) -> list[str]:
    """The same by a heap of pairs, which takes n log n steps."""
    n = len(parts)
    before, after, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (worth := rank.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-worth, i, len(parts[i]) + len(parts[j])))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two has been merged otherwise
        parts[i], parts[j] = parts[i] + parts[j], ""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return list(filter(None, parts))


def _merge(vocabulary: Vocabulary, text: str) -> list[int]:
    parts = (_merged_short if len(text) <= SHORT else _merged_long)(vocabulary.rank, list(text))
    number = vocabulary.number
    try:
        return [number[part] for part in parts]
    except KeyError:
        return [i for part in parts for i in ([number[part]] if part in number else [vocabulary.byte_ids[b] for b in part.encode()])]


def merge(vocabulary: Vocabulary, text: str) -> list[int]:
    """Ids of an (already normalised) text in BPE mode, its parts one after the other."""
    if len(text) <= SHORT:
        return _merge(vocabulary, text)
    out, begin = [], 0
    while begin < len(text):
        end = vocabulary.next_cut(text, begin + 1)
        out.extend(_merge(vocabulary, text[begin:end]))
        begin = end
    return out


@dataclass
class Solved:
    """Best sums [rows, positions] from each row's entry, the length of the last piece there, and its id."""

    best: np.ndarray
    back: np.ndarray
    last: np.ndarray

    def trace(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best path of each row to its end, laid end to end, and how many each row has; -1 - c
        stands for an unknown character c."""
        at, rows = ends.copy(), np.arange(len(ends))
        owners, ids = [], []
        while True:
            rows = rows[self.back[rows, at[rows]] > 0]
            if not len(rows):
                break
            owners.append(rows)
            ids.append(self.last[rows, at[rows]])
            at[rows] -= self.back[rows, at[rows]]
        if not owners:
            return np.zeros(0, dtype=np.int32), np.zeros(len(ends), dtype=np.int64)
        owner = np.concatenate(owners[::-1])  # from the first piece of a row to its last
        return np.concatenate(ids[::-1])[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(ends))


def solve(vocabulary: Vocabulary, codes: np.ndarray, sizes: np.ndarray, entries: np.ndarray) -> Solved:
    """All rows of characters [rows, width] at once, position by position, each from its own entry."""
    rows, width = codes.shape
    longest = min(vocabulary.longest, width)
    scores = vocabulary.weights
    arcs, names = [], []
    h = np.zeros((rows, width), dtype=np.uint64)
    place = np.arange(width)
    for size in range(1, longest + 1):
        h = h[:, : width - size + 1] * _B + (codes[:, size - 1 :] + np.uint64(1))
        ids = vocabulary.find(common._scramble(h))
        ids[place[None, : width - size + 1] + size > sizes[:, None]] = -1
        worth = scores[ids]
        if size == 1:
            alone = (ids < 0) & (place[None, :] < sizes[:, None])
            worth[alone] = vocabulary.unknown_score
            ids[alone] = -1 - codes[alone].astype(np.int32)
        arcs.append(worth)
        names.append(ids)
    best = np.full((rows, width + 1), NEVER)
    best[np.arange(rows), entries] = 0.0
    back = np.zeros((rows, width + 1), dtype=np.int16)
    last = np.zeros((rows, width + 1), dtype=np.int32)
    for end in range(1, width + 1):
        for size in range(min(longest, end), 0, -1):
            value = best[:, end - size] + arcs[size - 1][:, end - size]
            better = value > best[:, end]
            if better.any():
                best[better, end] = value[better]
                back[better, end] = size
                last[better, end] = names[size - 1][better, end - size]
    return Solved(best, back, last)


def _best_sums(vocabulary: Vocabulary, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Best sum of each row, as ``solve`` has it, without the path; characters lie side by side for all rows."""
    codes = np.ascontiguousarray(codes.T)
    width, rows = codes.shape
    inside = np.arange(width)[:, None] < sizes[None, :]
    best = np.full((width + 1, rows), NEVER)
    best[0] = 0.0
    arcs, h = [], np.zeros((width, rows), dtype=np.uint64)
    for size in range(1, min(vocabulary.longest, width) + 1):
        h = h[: width - size + 1] * _B + (codes[size - 1 :] + np.uint64(1))
        ids = vocabulary.find(common._scramble(h))
        worth = vocabulary.weights[ids]
        if size == 1:
            worth[ids < 0] = vocabulary.unknown_score
        worth[~inside[size - 1 :]] = NEVER
        arcs.append(worth if size == 1 or (worth > NEVER).any() else None)
    for end in range(1, width + 1):
        for size, worth in enumerate(arcs[:end], 1):
            if worth is not None:
                np.maximum(best[end], best[end - size] + worth[end - size], out=best[end])
    return best[sizes, np.arange(rows)]


def _rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.zeros((len(texts), int(sizes.max())), dtype=np.uint64)
    inside = np.arange(codes.shape[1])[None, :] < sizes[:, None]
    codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return codes, sizes


def spell(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters as byte pieces, in ids of several rows laid end to end."""
    unknown = np.flatnonzero(ids < 0)
    if not len(unknown):
        return ids, sizes
    spelled = [[vocabulary.byte_ids[b] for b in chr(-1 - i).encode()] for i in ids[unknown].tolist()]
    more = np.zeros(len(ids), dtype=np.int64)
    more[unknown] = [len(x) - 1 for x in spelled]
    out = np.repeat(ids, more + 1)
    begins = unknown + np.concatenate([[0], np.cumsum(more[unknown])[:-1]])
    for at, x in zip(begins.tolist(), spelled, strict=True):
        out[at : at + len(x)] = x
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return out, sizes + np.bincount(owner, weights=more, minlength=len(sizes)).astype(np.int64)


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one behind the other."""
    begin = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - begin, sizes) + np.arange(int(sizes.sum()))]


def encode_segments(vocabulary: Vocabulary, different: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the segments laid end to end, how many each has, and each one's best sum. The sums of segments of
    about the same length are found together."""
    lengths = np.array([len(d) for d in different], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    sums = np.zeros(len(different))
    ordered = lengths[order]
    i = 0
    while i < len(order):
        width = int(ordered[i]) + int(ordered[i]) // 2 + 2
        most = max(1, 1_000_000 // (vocabulary.longest * width))
        j = min(i + most, int(np.searchsorted(ordered, width, side="right")))
        part = order[i:j]
        codes, sizes = _rows([different[k] for k in part.tolist()])
        sums[part] = _best_sums(vocabulary, codes, sizes)
        i = j
    ids = [merge(vocabulary, d) for d in different]
    return np.array(list(chain.from_iterable(ids)), dtype=np.int32), np.array([len(x) for x in ids], dtype=np.int64), sums


class Encoder:
    """Encodes texts and remembers the segments it has solved, up to ``most`` of them."""

    def __init__(self, vocabulary: Vocabulary, most: int = 400_000):
        self.vocabulary, self.most = vocabulary, most
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.sizes, self.sums = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0)

    def texts(self, texts: list[str]) -> tuple[list[np.ndarray], list[float]]:
        """Ids and best sum of each (already normalised) text."""
        if len(self.number) > self.most:
            self._forget()
        number, known = self.number, len(self.number)
        of_text = [np.array([number.setdefault(s, len(number)) for s in segments(t, self.vocabulary)], dtype=np.int64) for t in texts]
        if len(number) > known:
            fresh = list(islice(reversed(number), len(number) - known))[::-1]
            flat, sizes, sums = encode_segments(self.vocabulary, fresh)
            self.flat, self.sizes, self.sums = (np.concatenate(x) for x in ((self.flat, flat), (self.sizes, sizes), (self.sums, sums)))
        starts = np.cumsum(self.sizes) - self.sizes
        return [_gather(self.flat, starts[n], self.sizes[n]) for n in of_text], [float(self.sums[n].sum()) for n in of_text]


def encode_texts(vocabulary: Vocabulary, texts: list[str]) -> tuple[list[np.ndarray], list[float]]:
    return Encoder(vocabulary).texts(texts)


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of the text that ``ids`` spell, without the mark put in front."""
    out = b"".join(map(vocabulary.spelled.__getitem__, ids.tolist()))
    return out[1:] if out[:1] == b" " else out


# -- chunks of giant texts ---------------------------------------------------------------------------


@dataclass
class Chunk:
    """A chunk with what follows it, and its parts: the first segment, those inside, the last one."""

    first: str
    inside: list[str]
    last: str | None  # None if the first segment is the only one
    size: int  # characters of the chunk itself

    @staticmethod
    def of(vocabulary: Vocabulary, text: str, ahead: str) -> Chunk:
        parts = segments(text, vocabulary)
        # what follows belongs to the last segment up to where the next one begins
        more = segments(parts[-1] + ahead, vocabulary)[0][len(parts[-1]) :] if parts else ""
        if len(parts) == 1:
            return Chunk(parts[0] + more, [], None, len(text))
        return Chunk(parts[0], parts[1:-1], parts[-1] + more, len(text))

    @property
    def last_size(self) -> int:
        """Characters of the chunk in its last segment."""
        return self.size - len(self.first) - sum(map(len, self.inside))


def _solve_one(vocabulary: Vocabulary, text: str, entries: list[int]) -> Solved:
    codes, sizes = _rows([text] * len(entries))
    return solve(vocabulary, codes, sizes, np.array(entries))


def transfers(encoder: Encoder, chunks: list[Chunk]) -> list[np.ndarray]:
    """The chunks as matrices of best sums [state at the start, state at the end]; a state counts characters
    of the chunk behind the cut that the piece across it has taken."""
    return _weighed(encoder, chunks)[0]


def _weighed(encoder: Encoder, chunks: list[Chunk]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The matrices of the chunks, and the ids of the segments inside them."""
    ids, inner = encoder.texts(["".join(c.inside) for c in chunks])
    return [_transfer(encoder.vocabulary, c, x) for c, x in zip(chunks, inner, strict=True)], ids


def _transfer(vocabulary: Vocabulary, chunk: Chunk, inner: float) -> np.ndarray:
    states = vocabulary.longest
    out = np.full((states, states), NEVER)
    entries = [i for i in range(states) if i <= len(chunk.first)]
    first = _solve_one(vocabulary, chunk.first, entries)
    if chunk.last is None:
        for row, i in enumerate(entries):
            for j in range(min(states, len(chunk.first) - chunk.size + 1)):
                out[i, j] = first.best[row, chunk.size + j]
            if i > chunk.size:  # a piece from before reaches over the whole chunk
                out[i, :] = NEVER
                out[i, i - chunk.size] = 0.0
        return out
    last = _solve_one(vocabulary, chunk.last, [0])
    ends = [last.best[0, chunk.last_size + j] if chunk.last_size + j <= len(chunk.last) else NEVER for j in range(states)]
    for row, i in enumerate(entries):
        out[i] = first.best[row, len(chunk.first)] + inner + np.array(ends)
    return out


def _path(vocabulary: Vocabulary, text: str, entry: int, end: int) -> list[int]:
    return spell(vocabulary, *_solve_one(vocabulary, text, [entry]).trace(np.array([end])))[0].tolist()


def trace_chunks(encoder: Encoder, chunks: list[Chunk], entries: list[int], leaves: list[int]) -> list[list[int]]:
    """For each chunk the ids of the pieces that begin in it, on the path of the best sum between its two states."""
    v, out = encoder.vocabulary, []
    for c, i, j in zip(chunks, entries, leaves, strict=True):
        if c.last is None:
            out.append(_path(v, c.first, i, c.size + j) if i < c.size + j else [])
        else:
            middle = [k for part in c.inside for k in _path(v, part, 0, len(part))]
            out.append(_path(v, c.first, i, len(c.first)) + middle + _path(v, c.last, 0, c.last_size + j))
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def states_between(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states at all cuts of a row of chunks, both ends included, on the best path from ``entry`` to ``leave``."""
    reach = [np.full(matrices[0].shape[0], NEVER)]
    reach[0][entry] = 0.0
    for m in matrices:
        reach.append((reach[-1][:, None] + m).max(axis=0))
    out = [leave]
    for k in range(len(matrices) - 1, -1, -1):
        out.append(int((reach[k] + matrices[k][:, out[-1]]).argmax()))
    return out[::-1]


def _matrix(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, dtype=np.float64)
    return flat.reshape(int(len(flat) ** 0.5), -1)


def chunk_ids(vocabulary: Vocabulary, body: str, inside: np.ndarray, head: int, tail: str) -> np.ndarray:
    """Ids of what begins in a chunk behind its first ``head`` characters, which belong to the chunk before;
    ``tail`` is the rest of its last part, and ``inside`` are the ids of its segments but the first and last."""
    parts = segments(body, vocabulary)
    if len(parts) == 1:
        return np.array(merge(vocabulary, body[head:] + tail), dtype=np.int32) if head < len(body) else np.zeros(0, dtype=np.int32)
    first, last = merge(vocabulary, parts[0][head:]), merge(vocabulary, parts[-1] + tail)
    return np.concatenate([np.array(first, dtype=np.int32), inside, np.array(last, dtype=np.int32)])


def cuts_of(vocabulary: Vocabulary, text: str, size: int):
    """Start of each chunk, how many of its characters belong to a part that began before, and what its last
    part has behind the chunk."""
    head = 0
    for start in range(0, len(text), size):
        end = min(start + size, len(text))
        after = vocabulary.next_cut(text, end) if head < end else head
        yield start, min(head, end) - start, text[end:after] if head < end else ""
        head = after


def _giant(docs: DataFrame, sent, longest: int, size: int) -> DataFrame:
    """doc_id, row_key, ids (little-endian 32-bit numbers) and score of texts longer than a chunk."""
    key = ["doc_id", "row_key"]

    def cut(batches):
        for batch in batches:
            for doc_id, row_key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_key", "text")), strict=True):
                text = normalised(text)
                cuts = cuts_of(sent.value, text, size)
                while part := list(islice(cuts, 64)):
                    starts, heads, tails = zip(*part, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([doc_id] * len(part), pa.int64()), "row_key": pa.array([row_key] * len(part), pa.int64()),
                            "chunk": pa.array([s // size for s in starts], pa.int64()), "head": pa.array(heads, pa.int64()), "tail": pa.array(tails, pa.string()),
                            "body": [text[s : s + size] for s in starts], "ahead": [text[s + size : s + size + longest - 1] for s in starts],
                        }
                    )

    def weigh(batches):
        encoder = Encoder(sent.value)
        for batch in common.batches_of(batches, "body"):
            bodies, aheads, heads, tails = (batch.column(c).to_pylist() for c in ("body", "ahead", "head", "tail"))
            matrices, inside = _weighed(encoder, [Chunk.of(sent.value, b, a) for b, a in zip(bodies, aheads, strict=True)])
            ids = [chunk_ids(sent.value, *x).astype("<i4").tobytes() for x in zip(bodies, inside, heads, tails, strict=True)]
            held = [batch.column(c) for c in (*key, "chunk")]
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(ids, pa.binary()), pa.array([m.tobytes() for m in matrices], pa.binary())], names=[*key, "chunk", "ids", "matrix"]
            )

    cuts = docs.distinct().mapInArrow(cut, "doc_id bigint, row_key bigint, chunk bigint, head bigint, tail string, body string, ahead string")
    weighed = cuts.repartition("row_key", "chunk").mapInArrow(weigh, "doc_id bigint, row_key bigint, chunk bigint, ids binary, matrix binary")
    chunks = written(weighed.withColumn("block", F.expr(f"chunk div {BLOCK}")), "piece-chunks")

    def multiply(order: str):
        def product_of(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(order)
            product = None
            for m in map(_matrix, rows["matrix"]):
                product = m if product is None else times(product, m)
            if order == "block":
                return rows.head(1)[key].assign(score=float(product[0, 0]))
            return rows.head(1)[[*key, "block"]].assign(matrix=[product.tobytes()])

        return product_of

    light = chunks.select(*key, "block", "chunk", "matrix")
    blocks = light.groupBy(*key, "block").applyInPandas(multiply("chunk"), "doc_id bigint, row_key bigint, block bigint, matrix binary")
    sums = blocks.groupBy(*key).applyInPandas(multiply("block"), "doc_id bigint, row_key bigint, score double")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda c: F.hex(c["ids"])), "")
    joined = chunks.groupBy(*key).agg(F.unhex(ids).alias("ids"))
    names = sums.withColumnsRenamed({"doc_id": "d", "row_key": "r"})
    return joined.join(names, (F.col("row_key") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d"))).select(*key, "ids", "score")


def _parts(docs: DataFrame, chunk: int, sent, longest: int) -> tuple[DataFrame, DataFrame]:
    """Texts of one chunk (doc_id, text, row_key), and the longer ones with their ids and scores."""
    rows = common.texts(docs).withColumn("row_key", common.row_key())
    long = F.length("text") >= chunk  # with the mark in front, longer than a chunk
    giants = rows.filter(long)
    found = _giant(giants, sent, longest, chunk)
    met = giants.join(found, common.same_row(giants, found)).select(giants["doc_id"], giants["text"], giants["row_key"], "ids", "score")
    return rows.filter(~long), met


def _encode(encoder: Encoder, batch: pa.RecordBatch) -> tuple[list[bytes], list[float]]:
    ids, scores = encoder.texts([normalised(t) for t in batch.column("text").to_pylist()])
    return [i.astype("<i4").tobytes() for i in ids], scores


def encoded(docs: DataFrame, vocabulary: Vocabulary | None = None, model_path: str = MODEL_PATH, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text, row_key, ``ids`` (little-endian 32-bit numbers) and ``score`` of every row.

    A null or empty text has no pieces and a score of 0.
    """
    vocabulary = vocabulary or Vocabulary.read(model_path)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the model's pieces: of fixed size

    def encode(batches):
        encoder = Encoder(sent.value)
        for batch in common.batches_of(batches):
            ids, scores = _encode(encoder, batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "ids", "score"])

    short, giants = _parts(docs, chunk, sent, vocabulary.longest)
    return short.mapInArrow(encode, "doc_id bigint, text string, row_key bigint, ids binary, score double").unionByName(giants)


def piece_digests(docs: DataFrame, model_path: str = MODEL_PATH, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_pieces, score, ids_sha256 (of the ids as little-endian 32-bit numbers), round_trip.

    round_trip: decoding the ids gives the text back; false only for texts that hold the mark of space itself.
    """
    vocabulary = Vocabulary.read(model_path)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def digest(batch: pa.RecordBatch, ids: list[bytes], scores) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        same = [decode(sent.value, np.frombuffer(i, dtype="<i4")) == t.encode() for i, t in zip(ids, texts, strict=True)]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"), "n_pieces": pa.array([len(i) // 4 for i in ids], pa.int64()), "score": pa.array(scores, pa.float64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()), "round_trip": pa.array(same, pa.bool_()),
            }
        )

    def encode_short(batches):
        encoder = Encoder(sent.value)
        for batch in common.batches_of(batches, size=2_000_000):
            yield digest(batch, *_encode(encoder, batch))

    def digest_giant(batches):
        for batch in batches:
            yield digest(batch, batch.column("ids").to_pylist(), batch.column("score").to_pylist())

    schema = "doc_id bigint, n_pieces bigint, score double, ids_sha256 string, round_trip boolean"
    short, giants = _parts(docs, chunk, sent, vocabulary.longest)
    return short.mapInArrow(encode_short, schema).unionByName(giants.mapInArrow(digest_giant, schema))
