"""Toxicity by a bidirectional gated recurrent network over words and their characters.

A word enters as a hashed word vector beside the mean of the vectors of its hashed character trigrams.
Forward and backward GRUs read windows of ``WINDOW`` words that overlap by half; attention pools the
states of a window into one logit. A text's logit is the largest of its windows, so the label of a text
trains the window that speaks loudest. All of it is numpy; scoring takes whole texts, all windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.llm.quality import _curve
from quillmill.llm.recurrent import Adam, gru, gru_back, sigmoid

WINDOW, STRIDE = 48, 24
WORD_ROWS, CHAR_ROWS, WORD_SIZE, CHAR_SIZE, STATE = 1 << 16, 1 << 13, 8, 8, 8
#: Labelled texts of each class used for fitting, and characters of each: the documented bound of the sample.
PER_CLASS, SAMPLE_CHARS = 1500, 3000
EPOCHS, LEAST_STEPS, RATE, SEED = 6, 280, 0.01, 5
TOXIC_FROM = 0.5
#: Windows that go through the network together.
TOGETHER = 4096

# bytes as they enter words: A-Z lowered, other bytes than letters, digits and those of other scripts part words
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_PART = np.ones(256, dtype=bool)
_PART[48:58] = _PART[97:123] = _PART[128:] = False


@dataclass(frozen=True)
class Model:
    weights: dict[str, np.ndarray]
    slope: float
    intercept: float


def new_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    inputs = WORD_SIZE + CHAR_SIZE
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    weights = {
        "word": np.zeros((WORD_ROWS, WORD_SIZE), dtype=np.float32),  # a word not seen in fitting says nothing by itself
        "char": (0.3 * rng.standard_normal((CHAR_ROWS, CHAR_SIZE))).astype(np.float32),
        "attend": draw(2 * STATE, STATE), "heed": draw(STATE, 1)[:, 0], "out": draw(2 * STATE, 1)[:, 0], "bias": np.zeros(1, dtype=np.float32),
    }
    for side in "fb":
        weights |= {f"w{side}": draw(inputs, 3 * STATE), f"u{side}": draw(STATE, 3 * STATE), f"c{side}": np.zeros(3 * STATE, dtype=np.float32)}
    return weights


@dataclass
class Batch:
    """Different words of some texts by their rows in the tables, and the texts as windows of word numbers."""

    word_rows: np.ndarray
    char_rows: np.ndarray
    char_word: np.ndarray
    windows: np.ndarray  # [n, WINDOW] numbers of words, -1 beyond the end
    text_of: np.ndarray
    n_texts: int


def encode(data: np.ndarray, offsets: np.ndarray) -> Batch:
    """Texts laid end to end as a batch. A text's last window ends at its last word; none has no word."""
    low = _LOW[data]
    blank = np.where(_PART[low], np.uint8(32), low)
    starts, ends, owner = common.words_of(blank, offsets)
    hashes = common.word_hashes(blank, starts, ends)
    different, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    # trigrams of the word between two marks, or the marks with what there is
    sizes = np.maximum(e - s, 1)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, dtype=np.int64)
    word_no = np.repeat(np.arange(len(sizes)), sizes)
    at = s[word_no] + np.arange(len(word_no)) - begin[word_no] if len(sizes) else np.zeros(0, dtype=np.int64)
    padded = np.concatenate([[32], blank, [32]]).astype(np.uint32)
    mid = padded[at + 1]
    left = np.where(at == s[word_no], 1, padded[at])
    right = np.where(at == e[word_no] - 1, 2, padded[at + 2])
    trigram = (left * np.uint32(65599) + mid) * np.uint32(65599) + right
    char_rows = ((trigram * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int64)
    n_texts = len(offsets) - 1
    counts = np.bincount(owner, minlength=n_texts)
    n_windows = np.where(counts == 0, 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)))
    text_of = np.repeat(np.arange(n_texts), n_windows)
    word_start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    nth = np.arange(len(text_of)) - np.repeat(np.concatenate([[0], np.cumsum(n_windows)[:-1]]), n_windows)
    start = np.minimum(nth * STRIDE, np.maximum(counts[text_of] - WINDOW, 0))
    place = start[:, None] + np.arange(WINDOW)[None, :]
    inside = place < counts[text_of][:, None]
    windows = np.where(inside, np.append(number, -1)[np.where(inside, word_start[text_of][:, None] + place, len(number))], -1)
    return Batch((different & np.uint64(WORD_ROWS - 1)).astype(np.int64), char_rows, word_no, windows, text_of, n_texts)


def _inputs(w: dict, batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the different words, and how many trigrams each has."""
    n = len(batch.word_rows)
    starts = np.searchsorted(batch.char_word, np.arange(n))
    chars = np.add.reduceat(w["char"][batch.char_rows], starts, axis=0) if n else np.zeros((0, CHAR_SIZE), dtype=np.float32)
    counts = np.bincount(batch.char_word, minlength=n).astype(np.float32)[:, None]
    return np.concatenate([w["word"][batch.word_rows], chars / counts], axis=1), counts


def _forward(w: dict, vectors: np.ndarray, windows: np.ndarray, keep: bool = False):
    numbers = windows.T  # time first
    mask = (numbers >= 0).astype(np.float32)
    sides = []
    for side in "fb":
        projected = vectors @ w[f"w{side}"] + w[f"c{side}"]
        turn = slice(None) if side == "f" else slice(None, None, -1)
        x = projected[np.maximum(numbers[turn], 0)]
        states, held = gru(w[f"u{side}"], x, mask[turn], keep)
        sides.append((x, states, held))
    hidden = np.concatenate([sides[0][1], sides[1][1][::-1]], axis=2)
    lean = np.tanh(hidden @ w["attend"])
    scores = lean @ w["heed"] + (mask - 1) * 1e4
    weight = np.exp(scores - scores.max(axis=0))
    weight *= mask
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = (weight[:, :, None] * hidden).sum(axis=0)
    return pooled @ w["out"] + w["bias"][0], (mask, sides, hidden, lean, weight, pooled)


def _backward(w: dict, vectors: np.ndarray, batch: Batch, counts: np.ndarray, windows: np.ndarray, state, d_logit: np.ndarray) -> dict:
    mask, sides, hidden, lean, weight, pooled = state
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], dtype=np.float32)}
    d_pooled = d_logit[:, None] * w["out"]
    d_weight = (hidden * d_pooled).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_lean = d_score[:, :, None] * w["heed"] * (1 - lean * lean)
    g["heed"] = np.einsum("tb,tbh->h", d_score, lean)
    g["attend"] = np.einsum("tbi,tbj->ij", hidden, d_lean)
    d_hidden = weight[:, :, None] * d_pooled + d_lean @ w["attend"].T
    numbers = np.maximum(windows.T, 0)
    d_vectors = np.zeros_like(vectors)
    for k, side in enumerate("fb"):
        turn = slice(None) if side == "f" else slice(None, None, -1)
        x, _, held = sides[k]
        dx, g[f"u{side}"] = gru_back(w[f"u{side}"], x, mask[turn], held, d_hidden[turn][:, :, k * STATE : (k + 1) * STATE])
        dx *= mask[turn][:, :, None]
        d_projected = np.zeros((len(vectors), 3 * STATE), dtype=np.float32)
        np.add.at(d_projected, numbers[turn].ravel(), dx.reshape(-1, 3 * STATE))
        g[f"w{side}"], g[f"c{side}"] = vectors.T @ d_projected, d_projected.sum(axis=0)
        d_vectors += d_projected @ w[f"w{side}"].T
    g["word"] = np.zeros_like(w["word"])
    np.add.at(g["word"], batch.word_rows, d_vectors[:, :WORD_SIZE])
    g["char"] = np.zeros_like(w["char"])
    np.add.at(g["char"], batch.char_rows, (d_vectors[:, WORD_SIZE:] / counts)[batch.char_word])
    return g


def text_logits(w: dict, batch: Batch) -> np.ndarray:
    """The largest logit of each text's windows; the bias for a text without words."""
    out = np.full(batch.n_texts, -np.inf, dtype=np.float64)
    vectors, _ = _inputs(w, batch)
    for i in range(0, len(batch.windows), TOGETHER):
        logits, _ = _forward(w, vectors, batch.windows[i : i + TOGETHER])
        np.maximum.at(out, batch.text_of[i : i + TOGETHER], logits)
    return np.where(np.isfinite(out), out, float(w["bias"][0]))


def _lay(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    held = [t.encode() for t in texts]
    return np.frombuffer(b"".join(held), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64)


def fit(sample: list[tuple[str, int]], base_rate: float | None = None, epochs: int = EPOCHS) -> Model:
    """From (text, label) pairs. Each step takes some texts, finds their loudest windows, and follows the
    gradient of the log loss through those. A fifth of the texts is held back for the curve that turns
    logits into probabilities, moved to ``base_rate``, the share of label 1 among all labelled rows.
    Without texts of both classes the score is the base rate (0.5 if unknown)."""
    rate = min(max(0.5 if base_rate is None else base_rate, 1e-3), 1 - 1e-3)
    if len({y for _, y in sample}) < 2 or len(sample) < 10:
        return Model(new_weights(), 0.0, float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(sample))
    held_back = max(2, len(sample) // 5)
    test, learn = [sample[i] for i in order[:held_back]], [sample[i] for i in order[held_back:]]
    w = new_weights()
    adam = Adam(w, RATE)
    epochs = max(epochs, -(-LEAST_STEPS * 64 // len(learn)))  # small samples are gone through more often
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs) + 1e-3
        mixed = rng.permutation(len(learn))
        for i in range(0, len(mixed), 64):
            part = [learn[j] for j in mixed[i : i + 64]]
            batch = encode(*_lay([t for t, _ in part]))
            if not len(batch.windows):
                continue
            y = np.array([label for _, label in part], dtype=np.float32)
            vectors, counts = _inputs(w, batch)
            logits, _ = _forward(w, vectors, batch.windows)
            # the loudest window of each text; in the first epoch one at random for clean texts, so that all are seen
            key = logits if epoch else np.where(y[batch.text_of] > 0, logits, rng.random(len(logits)))
            loudest = np.lexsort((key, batch.text_of))
            last = np.flatnonzero(np.append(batch.text_of[loudest][1:] != batch.text_of[loudest][:-1], True))
            chosen = loudest[last]
            windows = batch.windows[chosen]
            logits, state = _forward(w, vectors, windows, keep=True)
            d = ((sigmoid(logits) - y[batch.text_of[chosen]]) / len(chosen)).astype(np.float32)
            adam.step(w, _backward(w, vectors, batch, counts, windows, state, d))
    x = text_logits(w, encode(*_lay([t for t, _ in test])))
    y = np.array([label for _, label in test], dtype=float)
    if len(set(y)) < 2:
        return Model(w, 1.0, float(np.log(rate / (1 - rate))))
    slope, intercept = _curve(x, y)
    held = y.mean()
    return Model(w, slope, intercept + float(np.log(rate / (1 - rate)) - np.log(held / (1 - held))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of the labelled rows outside fold 0."""
    sample = common.labelled_sample(docs, labels, "toxic", per_class, chars)
    share = labels.filter(common.fold() != 0).filter("toxic in (0, 1)").agg(F.avg(F.col("toxic").cast("double"))).first()
    return fit(sample, share[0])


def toxicity_scores(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null, empty or wordless text has the bias's score."""
    model = model or train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size, 2.5 MB

    def score(batches):
        m = sent.value
        for batch in common.batches_of(batches):
            logits = text_logits(m.weights, encode(*common.joined_bytes(batch.column("text"))))
            found = 1 / (1 + np.exp(-np.clip(m.slope * logits + m.intercept, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = common.texts(docs).mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (common.fold() == 0).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )
