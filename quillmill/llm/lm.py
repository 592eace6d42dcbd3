"""LM scoring by a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

The model predicts classes: the most frequent words, the end of a text, and four classes that hold all
other words by length. The two classes before a token, each turned by its own matrix, add up to a vector
whose product with a class's vector is the class's score; products of all contexts with all classes, in
batches, give log-probabilities that sum to one. A word of a length class then has its share of that
class by corpus counts: log P = log P(class | two before) + log P(word | class).

The network learns from every token of the training part: tasks count how often each class follows each two,
and these counts, of fixed size, are all that its loss depends on.

Counts are exact over the whole training part. Frequent words, found in a bounded sample, are counted in
each task; every other word is shuffled by its hash, meets its count there, and only sums per document
come back. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.llm.recurrent import Adam, sigmoid
from quillmill.session import written

HELD_OUT_FOLD = 1
#: The bounded sample that names the frequent words: texts, and characters of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 1500, 10_000
#: Frequent words that are counted in the tasks, and those of them that are classes of their own.
FREQUENT, OWN = 20_000, 155
LENGTHS = [4, 8, 12]  # bytes; a word of up to so many is in the class, longer ones in the last
LENGTH_CLASSES = len(LENGTHS) + 1
END = OWN
CLASSES = OWN + 1 + LENGTH_CLASSES
SIZE, NOISE, EPOCHS, RATE, SEED = 16, 100, 200, 0.03, 3
TRIPLE_ROWS = 100_000  # rows of a batch that a task sends

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


@dataclass
class Tokens:
    """Words of texts laid end to end: hash, length class, text."""

    hashes: np.ndarray
    kind: np.ndarray
    text_of: np.ndarray
    n_texts: int

    @staticmethod
    def of(column) -> Tokens:
        data, offsets = common.joined_bytes(column)
        low = _LOW[data]
        starts, ends, text_of = common.words_of(low, offsets)
        return Tokens(common.word_hashes(low, starts, ends), np.searchsorted(LENGTHS, ends - starts), text_of, len(offsets) - 1)


@dataclass(frozen=True)
class Frequent:
    """Hashes of the frequent words in order, each one's class (-1: by length) and length class, and exact counts."""

    hashes: np.ndarray
    own: np.ndarray
    kind: np.ndarray
    counts: np.ndarray

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word among the frequent ones, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def classes(self, tokens: Tokens, place: np.ndarray) -> np.ndarray:
        own = np.append(self.own, -1)[place]
        return np.where(own >= 0, own, OWN + 1 + tokens.kind)


def training_part(docs: DataFrame) -> DataFrame:
    return common.texts(docs).filter(common.fold() != HELD_OUT_FOLD)


def sample_texts(docs: DataFrame, most: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[str]:
    """Texts (of long ones a piece) of the training part with the smallest hashes of their ids."""
    h = F.xxhash64("doc_id", F.lit("lm"))
    picked = training_part(docs).select("doc_id", h.alias("h")).distinct().orderBy("h", "doc_id").limit(most)
    found = training_part(docs).join(F.broadcast(picked), "doc_id")  # at most ``most`` pairs of numbers
    start = F.pmod("h", F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    rows = found.select(F.substring(F.col("text"), start.cast("int"), F.lit(chars)).alias("piece"), "h", "doc_id")
    return [r["piece"] for r in rows.orderBy("h", "doc_id", "piece").limit(most).collect()]


def name_frequent(sample: Tokens, most: int = FREQUENT) -> Frequent:
    """The most frequent words of the sample (ties by hash), not counted yet."""
    hashes, first, n = np.unique(sample.hashes, return_index=True, return_counts=True)
    top = np.sort(np.lexsort((hashes, -n))[:most])
    return Frequent(hashes[top], np.full(len(top), -1), sample.kind[first[top]], np.zeros(len(top), dtype=np.int64))


def count_frequent(docs: DataFrame, named: Frequent) -> tuple[Frequent, np.ndarray, int]:
    """Exact counts over the training part: of the frequent words, of all words by length class, and of texts.

    Each task adds up its own texts and sends one row per frequent word. The most frequent words then
    become classes of their own.
    """
    sent = docs.sparkSession.sparkContext.broadcast(named)  # at most FREQUENT words

    def count(batches):
        m = sent.value
        totals = np.zeros(len(m.hashes) + LENGTH_CLASSES + 1, dtype=np.int64)
        for batch in common.batches_of(batches):
            tokens = Tokens.of(batch.column("text"))
            place = m.place(tokens.hashes)
            totals[: len(m.hashes)] += np.bincount(place[place >= 0], minlength=len(m.hashes))
            totals[len(m.hashes) : -1] += np.bincount(tokens.kind, minlength=LENGTH_CLASSES)
            totals[-1] += tokens.n_texts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(totals))), pa.array(totals)], names=["at", "n"])

    counted = training_part(docs).select("text").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    totals = np.zeros(len(named.hashes) + LENGTH_CLASSES + 1, dtype=np.int64)
    for row in counted.collect():  # one row per frequent word
        totals[row["at"]] = row["n"]
    counts = totals[: len(named.hashes)]
    own = np.full(len(counts), -1)
    chosen = np.lexsort((named.hashes, -counts))[:OWN]
    own[chosen] = np.arange(len(chosen))
    return Frequent(named.hashes, own, named.kind, counts), totals[len(named.hashes) : -1], int(totals[-1])


def rare_sums(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """Per document: sum of log10(count + 0.5) over its words that are not frequent, how many of them are
    known, and, for each length class, the number of words whose first training document (in order) it is.

    A word's rows meet in one task by its hash. Frequent words never get here, so no word has many rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def spread(batches):
        for batch in common.batches_of(batches):
            tokens = Tokens.of(batch.column("text"))
            rare = np.flatnonzero(sent.value.place(tokens.hashes) < 0)
            order = rare[np.lexsort((tokens.hashes[rare], tokens.text_of[rare]))]
            h, text = tokens.hashes[order], tokens.text_of[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])) if len(order) else order
            times = np.diff(np.append(first, len(order)))
            doc, key, train = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("doc", "key", "train"))
            text = text[first]
            packed = (times.astype(np.int64) << 32) | (key[text].astype(np.int64) << 8) | (train[text].astype(np.int64) << 4) | tokens.kind[order[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[first].view(np.int64)), pa.array(doc[text]), pa.array(packed)], names=["h", "doc", "packed"]
            )

    rows = common.texts(docs).select(
        "text", _doc().alias("doc"), _short_key().alias("key"), (common.fold() != HELD_OUT_FOLD).alias("train")
    )
    words = rows.mapInArrow(spread, "h bigint, doc bigint, packed bigint")
    times, train, kind = F.expr("shiftright(packed, 32)"), F.expr("(packed & 16) > 0"), F.expr("packed & 15")
    words = words.select("h", "doc", F.expr("shiftright(packed, 8) & 16777215").alias("key"), times.alias("tf"), train.alias("train"), kind.alias("kind"))
    count = F.expr("sum(if(train, tf, 0)) OVER (PARTITION BY h)")
    # rows of a word in order of training first, so the first row tells whether it is known
    nth = F.expr("row_number() OVER (PARTITION BY h ORDER BY train DESC, doc, key)")
    met = words.withColumn("c", count).withColumn("fresh", (nth == 1) & F.col("train"))
    return met.groupBy("doc", "key").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
        *[F.sum(F.expr(f"if(fresh and kind = {k}, 1, 0)")).alias(f"types_{k}") for k in range(LENGTH_CLASSES)],
    )


def _doc():
    """The id, or 64 bits of the text of a row without one: such rows are as many as they like."""
    return F.coalesce(F.col("doc_id"), F.xxhash64("text", F.lit("no id")))


def _short_key():
    """24 bits that tell texts under one id apart; a null id and id 0 differ in it as well."""
    return F.xxhash64("doc_id", "text", F.col("doc_id").isNull()).bitwiseAND(F.lit((1 << 24) - 1))


# -- the network -------------------------------------------------------------------------------------


def train(sequences: list[np.ndarray], shares: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights from rows of classes (each text's, ending with END)."""
    row = np.concatenate([np.zeros(0, dtype=np.int64), *sequences])
    one, two = contexts(row, np.repeat(np.arange(len(sequences)), np.array([len(s) for s in sequences], dtype=int)))
    return train_counts(count_triples(one, two, row, len(shares)), shares, epochs)


def train_counts(triples: np.ndarray, shares: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights from how often each class follows each two, [one before, two before, class], by noise-contrastive
    estimation: each token is told from ``NOISE`` classes drawn by their ``shares`` in the corpus.

    All tokens with the same class and context have the same loss, and so has their noise on average, so
    an epoch is one step over the loss of all tokens, with the noise's expectation in place of draws.
    """
    rng = np.random.default_rng(SEED)
    n = len(shares)
    draw = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
    noise = (shares + 1e-6) / (shares + 1e-6).sum()
    w = {
        "context": draw(n, SIZE), "target": draw(n, SIZE), "one": np.eye(SIZE, dtype=np.float32), "two": 0.5 * np.eye(SIZE, dtype=np.float32),
        "bias": np.log(noise).astype(np.float32),
    }
    total = triples.sum()
    if not total:
        return w
    true = (triples.reshape(n * n, n) / total).astype(np.float32)
    met = np.flatnonzero(true.any(axis=1))
    true = true[met]
    false = true.sum(axis=1)[:, None] * (NOISE * noise).astype(np.float32)
    log_noise = np.log(NOISE * noise).astype(np.float32)
    adam = Adam(w, RATE)
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        first, second = w["context"] @ w["one"], w["context"] @ w["two"]
        hidden = (first[:, None] + second[None]).reshape(n * n, SIZE)[met]
        d = (true + false) * sigmoid(hidden @ w["target"].T + (w["bias"] - log_noise)) - true
        d_hidden = np.zeros((n * n, SIZE), dtype=np.float32)
        d_hidden[met] = d @ w["target"]
        d_first, d_second = d_hidden.reshape(n, n, SIZE).sum(axis=1), d_hidden.reshape(n, n, SIZE).sum(axis=0)
        adam.step(w, {
            "context": d_first @ w["one"].T + d_second @ w["two"].T, "target": d.T @ hidden,
            "one": w["context"].T @ d_first, "two": w["context"].T @ d_second, "bias": d.sum(axis=0),
        })
    return w


def log_probabilities(w: dict[str, np.ndarray]) -> np.ndarray:
    """log10 P(class | one before, two before) for all contexts, [one, two, class], each row summing to 1."""
    n = len(w["bias"])
    out = np.empty((n, n, n), dtype=np.float32)
    second = w["context"] @ w["two"]
    for c in range(n):
        scores = (w["context"][c] @ w["one"] + second).astype(np.float64) @ w["target"].T.astype(np.float64) + w["bias"]
        scores -= scores.max(axis=1, keepdims=True)
        out[c] = (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)
    return out


@dataclass(frozen=True)
class Model:
    frequent: Frequent
    weights: dict[str, np.ndarray]
    end_count: int
    class_norm: np.ndarray  # log10 of what a length class's counts are divided by
    tokens: int  # N
    types: int  # V

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.types + 1)))


def class_rows(tokens: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All classes with each text's END, and the text of each."""
    ends = np.searchsorted(tokens.text_of, np.arange(tokens.n_texts), side="right")
    row = np.insert(classes, ends, END)
    return row, np.insert(tokens.text_of, ends, np.arange(tokens.n_texts))


def contexts(row: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each. A text begins after END."""
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(row) else np.zeros(0, dtype=bool)
    one = np.where(first, END, np.concatenate([[END], row[:-1]])[: len(row)])
    second = np.concatenate([[True], first[:-1]])[: len(row)]
    return one, np.where(first | second, END, np.concatenate([[END, END], row])[: len(row)])


def count_triples(one: np.ndarray, two: np.ndarray, row: np.ndarray, n: int = CLASSES) -> np.ndarray:
    return np.bincount((one * n + two) * n + row, minlength=n**3)


def corpus_triples(docs: DataFrame, frequent: Frequent) -> np.ndarray:
    """Exact counts of [one before, two before, class] over the whole training part, at most CLASSES^3.

    Each task adds up its own texts and sends one row per triple that it met.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT words

    def count(batches):
        totals = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in common.batches_of(batches):
            tokens = Tokens.of(batch.column("text"))
            row, owner = class_rows(tokens, sent.value.classes(tokens, sent.value.place(tokens.hashes)))
            one, two = contexts(row, owner)
            np.add.at(totals, (one * CLASSES + two) * CLASSES + row, 1)
        met = np.flatnonzero(totals)
        for i in range(0, len(met), TRIPLE_ROWS):
            part = met[i : i + TRIPLE_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(totals[part])], names=["at", "n"])

    counted = training_part(docs).select("text").mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # one row per triple
    totals = np.zeros(CLASSES**3, dtype=np.int64)
    totals[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return totals


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the sums of rare words per document that its scores need."""
    sample = Tokens.of(pa.array(sample_texts(docs), pa.string()))
    frequent, by_kind, n_texts = count_frequent(docs, name_frequent(sample))
    rare = written(rare_sums(docs, frequent), "lm-rare-words")
    types = rare.agg(*[F.coalesce(F.sum(f"types_{k}"), F.lit(0)) for k in range(LENGTH_CLASSES)]).first()
    by_length = frequent.own < 0
    in_class = by_kind - np.bincount(frequent.kind[~by_length], weights=frequent.counts[~by_length], minlength=LENGTH_CLASSES)
    known = frequent.counts > 0
    class_types = np.array(types, dtype=float) + np.bincount(frequent.kind[by_length & known], minlength=LENGTH_CLASSES)
    n_tokens, n_types = int(by_kind.sum()) + n_texts, int(sum(types) + known.sum() + (n_texts > 0))
    shares = np.zeros(CLASSES)
    shares[frequent.own[~by_length]] = frequent.counts[~by_length]
    shares[END], shares[OWN + 1 :] = n_texts, in_class
    weights = train_counts(corpus_triples(docs, frequent), shares / max(shares.sum(), 1))
    return Model(frequent, weights, n_texts, np.log10(in_class + 0.5 * (class_types + 1)), n_tokens, n_types), rare


def _dense(model: Model, tokens: Tokens, table: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: what needs no counts of rare words."""
    place = model.frequent.place(tokens.hashes)
    classes = model.frequent.classes(tokens, place)
    row, owner = class_rows(tokens, classes)
    one, two = contexts(row, owner)
    add = lambda values, at: np.bincount(at, weights=values, minlength=tokens.n_texts)
    neural = add(table[one, two, row].astype(np.float64), owner)
    counts = np.append(model.frequent.counts, 0)[place]
    logs = np.where(place >= 0, np.log10(counts + 0.5), 0.0)
    in_class = classes > END
    share = np.where(in_class, logs - model.class_norm[tokens.kind], 0.0)
    return {
        "n_tokens": np.bincount(owner, minlength=tokens.n_texts).astype(np.int64),
        "dense_known": add((counts > 0) & (place >= 0), tokens.text_of).astype(np.int64) + (model.end_count > 0),
        "dense_log": add(logs, tokens.text_of) + np.log10(model.end_count + 0.5),
        "dense_score": neural + add(share, tokens.text_of),
    }


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone. Repeated rows share one row of rare sums, which holds each of
    them, and take their part of it. With no training text all counts are 0.
    """
    model, rare = fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: FREQUENT words and the weights

    def score(batches):
        table = log_probabilities(sent.value.weights)
        for batch in common.batches_of(batches):
            found = _dense(sent.value, Tokens.of(batch.column("text")), table)
            held = [batch.column(c) for c in ("doc_id", "doc", "key", "held_out")]
            yield pa.RecordBatch.from_arrays([*held, *(pa.array(v) for v in found.values())], names=["doc_id", "doc", "key", "held_out", *found])

    rows = common.texts(docs).select("doc_id", "text", _doc().alias("doc"), _short_key().alias("key"), (common.fold() == HELD_OUT_FOLD).alias("held_out"))
    scored = rows.mapInArrow(
        score, "doc_id bigint, doc bigint, key bigint, held_out boolean, n_tokens bigint, dense_known bigint, dense_log double, dense_score double"
    )
    same = scored.withColumn("same", F.expr("count(*) OVER (PARTITION BY doc, key)"))
    met = same.join(rare.select("doc", "key", "rare_log", "rare_known"), ["doc", "key"], "left")
    part = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("same")
    return met.select(
        "doc_id", "held_out", "n_tokens", (F.col("dense_known") + part("rare_known")).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("dense_log") + part("rare_log") - F.col("n_tokens") * model.base_norm).alias("base_score"),
        (F.col("dense_score") + part("rare_log")).alias("score"),
    )
