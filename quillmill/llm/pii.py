"""Personal data by a character-level bidirectional LSTM with CRF transitions.

Windows of ``WINDOW`` characters overlap by half. The network gives each character a score per tag
(outside; begin and inside of each kind), the CRF adds transition scores, and Viterbi finds the best tag
row of each window. A span can show up in several windows: the one in whose middle it lies most decides,
over the whole text. Decoding is held to spans whose numbers add up (``_allowed``); all of those have an
@, a spelled-out one or ``FEWEST_DIGITS`` digits, so a window with none of them has no span whatever the
network says, and is not run. Spans of the base patterns stay; the network adds those clear of them.

Fitting uses a bounded sample of windows, labelled with the spans of the base patterns. In part of them a
value of a kind is written in a form that the patterns miss (``other_form``) and labelled as that kind, or
something that only looks like one (``lookalike``) and is left unlabelled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.llm.recurrent import Adam, lstm, lstm_back

KINDS = ["email", "ip", "card", "phone"]
# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Digits that a span of any kind but email has at least: an address of four numbers.
FEWEST_DIGITS = 4
_DIGITS = re.compile("[0-9]")
#: An @ in words: bracketed, or between a name and a host whose dots are in words too.
SPELLED = re.compile(r"[\[({] ?at ?[\])}]| at [A-Za-z0-9-]+ dot [A-Za-z]", re.IGNORECASE)
_ANCHOR = re.compile("[0-9@]|" + SPELLED.pattern, re.IGNORECASE)
_ANCHOR_JVM = "(?i)" + _ANCHOR.pattern

WINDOW, STRIDE = 128, 64
SYMBOLS, EMBED, STATE = 130, 16, 24  # code points below 128, all others, beyond the end
TAGS = 1 + 2 * len(KINDS)
#: Windows used for fitting: the documented bound of the sample.
SAMPLE_WINDOWS = 1200
#: Rounds over the sample, and the fewest steps of ``BATCH`` windows, whatever its size.
EPOCHS, STEPS, BATCH, RATE, SEED = 30, 160, 128, 0.02, 7
#: Characters of a sampled window that are learnt from, and in the first of which something is put in.
LEARNT, PUT_IN = 80, 36
#: Shares of the windows that get a value in another form and a lookalike, drawn anew in each round.
OTHER_FORMS, LOOKALIKES = 0.5, 0.25
#: Windows (candidates or not) under the cut of the sample: what reaches the driver does not grow with the corpus.
SAMPLED_FROM = 40 * SAMPLE_WINDOWS
TOGETHER = 256


def _luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum((2 * int(d)) % 9 if d != "9" else 9 for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each starts as far left of its @ as name characters go, after the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start; code points, end exclusive."""
    spans = [(0, *s) for s in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return spans
    spans += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return spans


def _codes(piece: str) -> np.ndarray:
    codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(WINDOW, SYMBOLS - 1, dtype=np.int64)
    out[: len(codes)] = np.minimum(codes, SYMBOLS - 2)
    return out


def window_starts(n: int) -> range:
    """Starts of the overlapping windows of a text of ``n`` characters."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def can_hold(piece: str) -> bool:
    """Whether a window can hold a span of any kind: an @, also in words, or the fewest digits that a kind needs."""
    return "@" in piece or len(_DIGITS.findall(piece)) >= FEWEST_DIGITS or SPELLED.search(piece) is not None


def candidate_windows(text: str) -> list[int]:
    """Starts of the windows that can hold a span."""
    if not _ANCHOR.search(text):
        return []
    return [s for s in window_starts(len(text)) if can_hold(text[s : s + WINDOW])]


@dataclass(frozen=True)
class Model:
    weights: dict[str, np.ndarray]


def new_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    weights = {
        "embed": (0.5 * rng.standard_normal((SYMBOLS, EMBED))).astype(np.float32),
        "out": draw(2 * STATE, TAGS), "lean": np.zeros(TAGS, dtype=np.float32), "moves": np.zeros((TAGS, TAGS), dtype=np.float32),
    }
    for side in "fb":
        weights |= {f"w{side}": draw(EMBED, 4 * STATE), f"u{side}": draw(STATE, 4 * STATE), f"c{side}": np.zeros(4 * STATE, dtype=np.float32)}
        weights[f"c{side}"][STATE : 2 * STATE] = 1.0  # remember at first
    return weights


def _barred() -> np.ndarray:
    """-1e4 for moves that no tag row may make: to the inside of a kind from anything but that kind."""
    out = np.zeros((TAGS, TAGS), dtype=np.float32)
    for kind in range(len(KINDS)):
        begin, inside = 1 + 2 * kind, 2 + 2 * kind
        out[:, inside] = -1e4
        out[[begin, inside], inside] = 0
    return out


BARRED = _barred()
START = np.where(np.isin(np.arange(TAGS), 2 + 2 * np.arange(len(KINDS))), -1e4, 0).astype(np.float32)


def emissions(w: dict, codes: np.ndarray, keep: bool = False):
    """Tag scores [T, B, TAGS] of windows [B, T], and what backward needs."""
    numbers = codes.T
    mask = (numbers != SYMBOLS - 1).astype(np.float32)
    sides = []
    for side in "fb":
        projected = w["embed"] @ w[f"w{side}"] + w[f"c{side}"]
        turn = slice(None) if side == "f" else slice(None, None, -1)
        x = projected[numbers[turn]]
        sides.append((x, *lstm(w[f"u{side}"], x, mask[turn], keep)))
    hidden = np.concatenate([sides[0][1], sides[1][1][::-1]], axis=2)
    return hidden @ w["out"] + w["lean"], (numbers, mask, sides, hidden)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray, tags: np.ndarray):
    """Log loss of the right tag rows, and its gradients by tag scores and moves (forward-backward)."""
    steps, batch, n = scores.shape
    m = moves + BARRED
    forward = np.empty_like(scores)
    forward[0] = scores[0] + START
    for t in range(1, steps):
        fresh = _logsum(forward[t - 1][:, :, None] + m, 1) + scores[t]
        forward[t] = np.where(mask[t][:, None] > 0, fresh, forward[t - 1])
    total = _logsum(forward[-1], 1)
    back = np.zeros_like(scores)
    d_moves = np.zeros_like(moves)
    rows = np.arange(batch)
    for t in range(steps - 2, -1, -1):
        after = scores[t + 1] + back[t + 1]
        on = mask[t + 1] > 0
        back[t] = np.where(on[:, None], _logsum(m + after[:, None, :], 2), back[t + 1])
        pair = np.exp(forward[t][:, :, None] + m + after[:, None, :] - total[:, None, None])
        d_moves += pair[on].sum(axis=0)
        np.add.at(d_moves, (tags[t][on], tags[t + 1][on]), -1)
    share = np.exp(forward + back - total[:, None])
    d_scores = share * mask[:, :, None]
    right = np.zeros(batch)
    for t in range(steps):
        on = mask[t] > 0
        d_scores[t, rows[on], tags[t][on]] -= 1
        right[on] += scores[t, rows[on], tags[t][on]]
        if t:
            right[on] += moves[tags[t - 1][on], tags[t][on]]
    return float((total - right).sum()), d_scores.astype(scores.dtype), d_moves.astype(moves.dtype)


def gradients(w: dict, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    scores, (numbers, mask, sides, hidden) = emissions(w, codes, keep=True)
    loss, d_scores, d_moves = crf_gradient(scores, w["moves"], mask, tags.T)
    g = {"moves": d_moves, "out": np.einsum("tbh,tbk->hk", hidden, d_scores), "lean": d_scores.sum(axis=(0, 1))}
    d_hidden = d_scores @ w["out"].T
    g["embed"] = np.zeros_like(w["embed"])
    for k, side in enumerate("fb"):
        turn = slice(None) if side == "f" else slice(None, None, -1)
        x, _, held = sides[k]
        dx, g[f"u{side}"] = lstm_back(w[f"u{side}"], x, mask[turn], held, d_hidden[turn][:, :, k * STATE : (k + 1) * STATE])
        d_projected = np.zeros((SYMBOLS, 4 * STATE), dtype=x.dtype)
        symbols = numbers[turn].ravel()
        order = np.argsort(symbols, kind="stable")
        present, starts = np.unique(symbols[order], return_index=True)
        d_projected[present] = np.add.reduceat(dx.reshape(-1, 4 * STATE)[order], starts, axis=0)
        g[f"w{side}"], g[f"c{side}"] = w["embed"].T @ d_projected, d_projected.sum(axis=0)
        g["embed"] += d_projected @ w[f"w{side}"].T
    return loss, {k: v / len(codes) for k, v in g.items()}


def viterbi(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Best tag rows [T, B]."""
    steps, batch, n = scores.shape
    m = moves + BARRED
    best = scores[0] + START
    came = np.zeros((steps, batch, n), dtype=np.int64)
    for t in range(1, steps):
        through = best[:, :, None] + m
        came[t] = through.argmax(axis=1)
        fresh = through.max(axis=1) + scores[t]
        on = mask[t][:, None] > 0
        best = np.where(on, fresh, best)
        came[t] = np.where(on, came[t], np.arange(n))
    tags = np.empty((steps, batch), dtype=np.int64)
    tags[-1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = came[t][np.arange(batch), tags[t]]
    return tags


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(str(d) for d in rng.integers(0, 10, n))


def _pick(rng: np.random.Generator, forms: list[str]) -> str:
    return forms[rng.integers(len(forms))]


def other_form(kind: int, rng: np.random.Generator, words: list[str]) -> str:
    """A made-up value of a kind, written in a way that the base patterns miss."""
    value = _written(kind, rng, words)
    return other_form(kind, rng, words) if base_spans(value) else value  # by chance a number is one of another kind


def _written(kind: int, rng: np.random.Generator, words: list[str]) -> str:
    if KINDS[kind] == "email":
        name = _pick(rng, words) + _pick(rng, ["", ".", "_"]) + _pick(rng, [_digits(rng, 2), _pick(rng, words)])
        at = _pick(rng, [" (at) ", " [at] ", "(at)", "[at]", " at ", " @ ", "@ ", " {at} "])
        dot = " dot " if at == " at " else _pick(rng, [".", ".", " dot ", " (dot) ", "[dot]"]) if "at" in at else "."
        return name + at + dot.join([_pick(rng, words) + _pick(rng, ["", _digits(rng, 1)]), _pick(rng, words), _pick(rng, ["com", "org", "net", "de"])][rng.integers(2) :])
    if KINDS[kind] == "ip":
        return _pick(rng, ["-", " . ", "[.]", " - ", "(.)", ". ", " .", ":", "_"]).join(str(n) for n in rng.integers(0, 256, 4))
    if KINDS[kind] == "card":
        lead = _pick(rng, ["4", "5", "6"]) + _digits(rng, 14)
        number = next(lead + d for d in "0123456789" if _luhn(lead + d))
        joints = [_pick(rng, [".", "/", "  ", " - ", "_", "\n", ". "])] * 3
        if rng.random() < 0.3:
            joints[rng.integers(1, 3)] = _pick(rng, [" ", "-", "."])
        return "".join(number[4 * i : 4 * i + 4] + joint for i, joint in enumerate([*joints, ""]))
    area, first, last = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    code = _pick(rng, ["1", "44", "49", "33"])
    sign = _pick(rng, ["-", ".", " "])
    return _pick(rng, [
        f"{code}-{area}-{first}-{last}", f"00{code} {area} {first}{last}", f"({area}) {first}-{last}", f"+{code}/{area}/{first}/{last}",
        f"{code} ({area}) {first}{sign}{last}", f"00{code}{sign}{area}{sign}{first}{sign}{last}", f"{area}-{first}-{last}", f"0{area[:2]}/{first}{last}",
    ])


def lookalike(rng: np.random.Generator) -> str:
    """A made-up date, time, version, amount, number or turn of phrase that is no personal data."""
    year, month, day = rng.integers(1900, 2040), rng.integers(1, 13), rng.integers(1, 29)
    hour, minute, n = rng.integers(24), rng.integers(60), rng.integers(1, 9, 4)
    return _pick(rng, [
        f"{year}-{month:02}-{day:02}", f"{day}.{month}.{year}", f"{month}/{day}/{year} {hour:02}:{minute:02}", f"{year}-{month:02}-{day:02}T{hour:02}:{minute:02}:{minute:02}",
        f"{year}-{month:02}-{day:02} {hour:02}:{minute:02}:{minute:02}", f"v{n[0]}.{n[1]}.{n[2]}", f"{n[0]}.{n[1]}.{_digits(rng, 2)}", f"{n[0]},{_digits(rng, 3)},{_digits(rng, 3)}",
        f"{n[0]},{_digits(rng, 3)},{_digits(rng, 3)},{_digits(rng, 3)}", _digits(rng, int(rng.integers(5, 20))), f"{n[0]}.{_digits(rng, 10)}", f"978-{n[0]}-{_digits(rng, 2)}-{_digits(rng, 6)}-{n[1]}",
        f"{year}-{year + 1}", f"#{_digits(rng, 8)}", f"{_digits(rng, 2)}-{_digits(rng, 4)}-{_digits(rng, 2)}", f"{n[0]} {n[1]} {n[2]} {n[3]}", f"(at {hour}:{minute:02})", f"at {n[0]} dot",
    ])


def labelled(window: str, rng: np.random.Generator, words: list[str]) -> tuple[str, list[tuple[int, int, int]]]:
    """A window for fitting and its spans: as it is, with a value in another form, or with a lookalike.

    What is put in takes the place of a span of the base patterns, or stands between two words.
    """
    draw, base = rng.random(), base_spans(window)
    if draw >= OTHER_FORMS + LOOKALIKES:
        return window, base
    if base and rng.random() < 0.5:
        _, a, b = base[rng.integers(len(base))]
    else:
        gaps = [m.end() for m in re.finditer(r"\s", window[:PUT_IN])]
        a = b = gaps[rng.integers(len(gaps))] if gaps else 0
    kind = int(rng.integers(len(KINDS))) if draw < OTHER_FORMS else -1
    put = lookalike(rng) if kind < 0 else other_form(kind, rng, words)
    before, after = window[:a], window[b:]
    if a == b:
        before, after = before + ("" if a == 0 else _pick(rng, ["", "(", "<"]) if rng.random() < 0.2 else ""), _pick(rng, [" ", " ", ", ", ". ", "\n", ") "]) + after
    text = before + put + after
    spans = [(max(kind, 0), len(before), len(before) + len(put))] if kind >= 0 else []
    base = base_spans(text)
    return text[:WINDOW], [(k, x, min(y, WINDOW)) for k, x, y in all_spans(base, spans) if x < WINDOW]


def _tags(spans: list[tuple[int, int, int]]) -> np.ndarray:
    row = np.zeros(WINDOW, dtype=np.int64)
    for kind, start, end in reversed(spans):
        row[start:end] = 2 + 2 * kind
        row[start] = 1 + 2 * kind
    before = 0
    for i, tag in enumerate(row):  # where kinds overlap the earlier listed won; an inside without its begin becomes one
        if tag and tag % 2 == 0 and before not in (tag, tag - 1):
            row[i] = tag - 1
        before = row[i]
    return row


def fit(windows: list[str], epochs: int = EPOCHS) -> Model:
    """From windows of text, each labelled anew in every round (``labelled``): ``epochs`` rounds, and more until ``STEPS`` steps.

    Without any window, weights that find nothing.
    """
    w = new_weights()
    if not windows:
        w["lean"][0] = 1e3
        return Model(w)
    rng = np.random.default_rng(SEED)
    words = sorted({x.lower() for piece in windows for x in re.findall("[A-Za-z]{2,10}", piece)}) or ["name"]
    epochs = max(epochs, -(-STEPS // -(-len(windows) // BATCH)))
    adam = Adam(w, RATE)
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs) + 1e-3
        mixed = rng.permutation(len(windows))
        for i in range(0, len(mixed), BATCH):
            drawn = [labelled(windows[k], rng, words) for k in mixed[i : i + BATCH]]
            adam.step(w, gradients(w, np.stack([_codes(t) for t, _ in drawn])[:, :LEARNT], np.stack([_tags(spans) for _, spans in drawn])[:, :LEARNT])[1])
    return Model(w)


def _allowed(kind: int, piece: str) -> bool:
    """What a span of the network must be to count: the numbers of its kind must add up, in whatever form."""
    if KINDS[kind] == "email":
        return "@" in piece or SPELLED.search(piece) is not None
    if re.search(r"[^\W\d_]", piece):
        return False
    digits = "".join(_DIGITS.findall(piece))
    if KINDS[kind] == "ip":
        parts = re.findall("[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return 9 <= len(digits) <= 15


def clear_of(spans: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``more`` that touch none of ``spans``."""
    ordered = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in ordered]
    ends = np.maximum.accumulate([b for _, b in ordered]) if ordered else []
    out = []
    for m in more:
        i = bisect_left(starts, m[2])
        if not i or ends[i - 1] <= m[1]:
            out.append(m)
    return out


def _reconciled(found: list[tuple]) -> list[tuple[int, int, int]]:
    """Spans ``(rank, kind, start, end)`` that touch no span of lower rank that stays, by start."""
    kept: list[tuple[int, int, int]] = []  # clear of each other, so the neighbours by start settle a clash
    for _, kind, start, end in sorted(found):
        i = bisect_left(kept, (start,))
        if (not i or kept[i - 1][1] <= start) and (i == len(kept) or end <= kept[i][0]):
            kept.insert(i, (start, end, kind))
    return sorted((kind, start, end) for start, end, kind in kept)


def decoded(model: Model, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans that the network finds in each text, reconciled over the windows."""
    places = [(k, s) for k, text in enumerate(texts) for s in candidate_windows(text)]
    found: list[list[tuple]] = [[] for _ in texts]
    for i in range(0, len(places), TOGETHER):
        part = places[i : i + TOGETHER]
        codes = np.stack([_codes(texts[k][s : s + WINDOW]) for k, s in part])
        scores, (_, mask, _, _) = emissions(model.weights, codes)
        tags = viterbi(scores, model.weights["moves"], mask).T
        for (k, s), row, size in zip(part, tags, mask.sum(axis=0).astype(int), strict=True):
            begins = np.flatnonzero(row[:size] % 2 == 1)
            for b in begins:
                rest = np.flatnonzero(row[b + 1 : size] != row[b] + 1)
                e = b + 1 + int(rest[0]) if len(rest) else size
                kind = int(row[b]) // 2
                if (b > 0 or s == 0) and (e < size or s + size >= len(texts[k])) and _allowed(kind, texts[k][s + b : s + e]):
                    off_middle = abs(2 * s + WINDOW - (2 * s + b + e))
                    found[k].append((off_middle, kind, s + int(b), s + int(e)))
    return [_reconciled(spans) for spans in found]


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def all_spans(base: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and those of the network that touch none of them."""
    return sorted(base + clear_of(base, more))


def sample_windows(docs: DataFrame, most: int = SAMPLE_WINDOWS) -> list[str]:
    """At most ``most`` windows of texts of the corpus that can hold a span, in the order of a hash of the window.

    The hash is cut so that some ``SAMPLED_FROM`` of all windows of such texts lie under it.
    """
    rows = common.texts(docs).filter(F.col("text").rlike(_ANCHOR_JVM)).select("text")
    every = rows.agg(F.sum(F.length("text") / STRIDE + 1)).first()[0] or 0
    below = int(2**62 * min(1.0, SAMPLED_FROM / max(every, 1.0))) * 2

    def cut(batches):
        for batch in batches:
            pieces = [t[s : s + WINDOW] for t in batch.column("text").to_pylist() for s in candidate_windows(t)]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string())], names=["piece"])

    pieces = rows.mapInArrow(cut, "piece string").withColumn("h", F.shiftrightunsigned(F.xxhash64("piece"), 1))
    pieces = pieces.filter(F.col("h") <= F.lit(min(below, 2**63 - 1)))
    return [r["piece"] for r in pieces.orderBy("h", "piece").limit(most).collect()]


SCHEMA = (
    "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"
)


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, all spans, and how many were added.

    A null or empty text has no spans, counts of 0 and the digest of the empty string. One pass.
    """
    import hashlib

    model = model or fit(sample_windows(docs))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # weights of fixed size, under 100 kB

    def find(batches):
        for batch in common.batches_of(batches):
            texts = batch.column("text").to_pylist()
            more = decoded(sent.value, texts)
            columns: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for text, added in zip(texts, more, strict=True):
                base = base_spans(text)
                together = all_spans(base, added)
                for kind in range(len(KINDS)):
                    columns[kind].append(sum(s[0] == kind for s in base))
                columns[-3].append(hashlib.sha256(named(base).encode()).hexdigest())
                columns[-2].append(named(together))
                columns[-1].append(len(together) - len(base))
            kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return common.texts(docs).mapInArrow(find, SCHEMA)
