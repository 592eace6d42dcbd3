"""Hard negatives, conversation repair and mixing against plain versions, on small made-up tables with nulls, ties,
repeated rows, long texts, empty tables and columns whose names clash."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillmill.llm import mixing, negatives, repair

# -- hard negatives ------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, vector string, cell int, score string"


def mined(rows):
    """Every pair of rows, in plain whole numbers."""
    held = {}
    for i, e, y in rows:
        if i is None or y is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = ((y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * x) for x in e])
        held[i] = min(held.get(i, row), row)
    found = []
    for a, (y, v) in held.items():
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, (z, w) in held.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == y][:5]:
            fits = [(n, j) for n, j, z in scored if z != y and 50 * -p <= 100 * -n <= 95 * -p][:3]
            found.extend((a, i, r, j, -p, -n) for r, (n, j) in enumerate(fits, 1))
    return sorted(found)


def some_vectors(seed, n, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    rows = []
    for k in range(n):
        y = int(rng.integers(0, 4))
        rows.append((int(rng.integers(-300, 700)), [float(np.float32(x)) for x in centres[y] + 0.7 * rng.standard_normal(dims)], y))
    same = rows[0][1]
    rows += [(k, same, 1) for k in range(1000, 1030)] + [(k, same, 2) for k in range(1030, 1060)]  # ties
    rows += [rows[3], rows[3], (rows[3][0], same, 0)]  # repeated rows, one id twice
    rows += [(50, None, 1), (51, [1.0], None), (100, [float("nan")] * dims, 2), (150, [None] * dims, 2), (200, [], 0),
             (250, [1.0, 2.0], 1), (None, same, 1), (-350, [float("inf")] + same[1:], 1), (300, [0.0] * dims, 3)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, rows, seed):
    data = some_vectors(seed, 500)
    df = spark.createDataFrame([(i, e, y, "v", 1, "s") for i, e, y in data], VECTORS)
    assert rows(negatives.hard_negatives(df)) == sorted(mined(data), key=repr)


def test_hard_negatives_of_many_cells(spark, rows, monkeypatch):
    data = some_vectors(3, 400)
    for name, value in (("ANCHORS", 2), ("SALTS", 3), ("BLOCK", 32), ("TOGETHER", 1), ("STEPS", (0, 1, 2, 3))):
        monkeypatch.setattr(negatives, name, value)
    df = spark.createDataFrame([(i, e, y, "v", 1, "s") for i, e, y in data], VECTORS)
    assert rows(negatives.hard_negatives(df)) == sorted(mined(data), key=repr)


def test_hard_negatives_of_nothing(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []


def test_hard_negatives_of_large_numbers(spark, rows):
    data = [(k, [float((k * 37 + d) % 11 - 5) * 1e5 for d in range(8)], k % 2) for k in range(120)]
    df = spark.createDataFrame([(i, e, y, "v", 1, "s") for i, e, y in data], VECTORS)
    assert rows(negatives.hard_negatives(df)) == sorted(mined(data), key=repr)
    huge = spark.createDataFrame([(i, [x * 1e20 for x in e], y, "v", 1, "s") for i, e, y in data], VECTORS)
    assert negatives.hard_negatives(huge).count() >= 0


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-20, 20, (4000, 4))
    vectors[:40] *= 40
    anchors = negatives.Anchors(np.arange(3), np.zeros(3, int), vectors[:3], np.full((3, 1), -(10**9)), np.full((3, 1), 10**9), 5, True)
    seen = negatives.look(anchors, np.arange(4000), np.zeros(4000, int), vectors)
    assert seen < 4000 * 3 / 4
    scores = vectors[:3] @ vectors.T
    for a in range(3):
        best = sorted((-int(s), i) for i, s in enumerate(scores[a]) if i != a)[:5]
        assert [(-int(s), int(i)) for s, i in zip(anchors.best.scores[a], anchors.best.ids[a])] == best


# -- repair of conversations ------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, at string, name string, piece string, kind string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """Damage, faults and the cheapest edits by a table over (cost, letters)."""
    text = lambda v: " " if v is None else str(v)
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c]
        kind = zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20
        r, x = text(r), text(x)
        if kind == 0:
            continue
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        r = "user" if kind == 4 else r
        convs[c].extend([(t, r, x)] * (2 if kind == 3 else 1))
    found = []
    for c, held in convs.items():
        held.sort(key=lambda h: (h[0] is not None, h[0] or 0, h[1].encode(), hashlib.md5(h[2].encode()).hexdigest()))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, faults, seen = Counter(), [], set()
        for t, r, x in held:
            last = x.rstrip(BLANKS)[-1:]
            fault = "blank" if not last else "duplicate" if (r, x) in seen else "truncated" if last not in ".!?" else ""
            seen.add((r, x))
            counts[fault] += 1
            faults.append(fault)
        initials = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
        best = {}

        def go(k, q):
            if (k, q) in best:
                return best[k, q]
            options = [(0, "", None)] if k == len(held) and q in ("", "a") else []
            if k < len(held):
                cost, letters, _ = go(k + 1, q)
                options.append((cost + 2, "D" + letters, (k + 1, q)))
                if faults[k] not in ("blank", "duplicate"):
                    more = 5 * (faults[k] == "truncated")
                    if initials[k] in after[q]:
                        cost, letters, _ = go(k + 1, after[q][initials[k]])
                        options.append((cost + more, "K" + letters, (k + 1, after[q][initials[k]])))
                    to = "a" if q == "u" else "u"
                    cost, letters, _ = go(k + 1, to)
                    options.append((cost + 1 + more, "R" + letters, (k + 1, to)))
            # two inserts in a row bring back the state at a cost, so one is enough
            best[k, q] = min(options, default=(10**9, "~", None))
            return best[k, q]

        plain = {}
        for k in range(len(held), -1, -1):  # without inserts first, then with one or two of them
            for q in ("", "s", "u", "a"):
                best.pop((k, q), None)
                plain[q] = go(k, q)
            for _ in range(3):
                for q in ("", "s", "u", "a"):
                    to = "a" if q == "u" else "u"
                    cost, letters, _ = best[k, to]
                    best[k, q] = min(best[k, q], (cost + 5, "I" + letters, (k, to)), key=lambda o: o[:2])
        cost, letters, _ = best[0, ""]
        made, q, k = [], "", 0
        for letter in letters:
            to = "a" if q == "u" else "u"
            if letter == "I":
                q, line = to, ({"u": "user", "a": "assistant"}[to], "")
                made.append(line)
                continue
            if letter == "R":
                q = to
                made.append(({"u": "user", "a": "assistant"}[to], held[k][2]))
            elif letter == "K":
                q = after[q][initials[k]]
                made.append(held[k][1:])
            k += 1
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()
        found.append(((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters, digest), made))
    return found


def some_turns(seed, convs=60, longest=9):
    rng = random.Random(seed)
    texts = ["Yes.", "no", " ", "", "Well!  \n", "Why?", "a.b", "\u00a0", "long " * 50 + ".", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, None if rng.random() < 0.05 else t + rng.choice([0, 0, 0, 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"{rng.random()}."))
    return rows + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (7, 1, "user", "Same."), (7, 1, "user", "Same.")]


def compared(spark, data):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in data], TURNS)
    plain = plain_repair(data)
    told = repair.repair_report(df)
    assert told.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(repr, map(tuple, told.collect()))) == sorted(repr(p) for p, _ in plain)
    lines = [(p[0], k, r, x) for p, made in plain for k, (r, x) in enumerate(made)]
    assert sorted(map(repr, map(tuple, repair.repaired_rows(df).collect()))) == sorted(map(repr, lines))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair(spark, seed):
    compared(spark, some_turns(seed))


def test_repair_of_long_conversations(spark):
    """One conversation with most of the rows, cut into many pieces."""
    rng = random.Random(9)
    roles, texts = ["user", "assistant", "system", "tool"], ["Yes.", "no", "", "Why?"]
    long = [(1000, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.3 else f"{t}{rng.choice(['.', ''])}") for t in range(700)]
    calm = [(1001, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(500)]
    compared(spark, some_turns(4, 20) + long + calm + [(1002, 5, "user", "x" * 200_000 + "."), (1002, -(2**40), "system", "Far.")])


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.repair_report(empty).collect() == [] and repair.repaired_rows(empty).collect() == []


def test_auction_equals_a_table():
    rng = random.Random(5)
    for _ in range(200):
        rows = [(rng.choice("suat"), rng.random() < 0.3, rng.random() < 0.3) for _ in range(rng.randint(0, 7))]
        costs = repair.between(rows, [0, 1, 2, 3])
        for end in range(4):
            go = {(len(rows), q): 0 if q == end else 10**9 for q in range(4)}
            for k in range(len(rows), -1, -1):
                for _ in range(4):
                    for q in range(4):
                        go[k, q] = min([go.get((k, q), 10**9), *[c + go.get((i, s), 10**9) for _, c, i, s in repair.arcs(rows, k, q)]])
            assert [costs[q][end] if costs[q][end] < repair.FAR else None for q in range(4)] == [go[0, q] if go[0, q] < 10**8 else None for q in range(4)]


# -- mixing ------------------------------------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, source string, size string, target string, _at string, _row string, copies string"


def some_documents(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "B", "\u00e9", "z", "\U0001f600", "", None] + ["hot"] * 6
    rows = [(rng.choice([k, k, 5, None]), " ".join("w" * rng.randint(1, 9) for _ in range(int(rng.paretovariate(1)) % 500)), rng.choice(sources)) for k in range(n)]
    return rows + [(1, None, "a"), (2, "", "none at all"), (3, " \n", "none at all"), (4, "x " * 5000, "tiny"), (9, "same", "z"), (9, "same", "z")]


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = 1.5 * total - sum(2 * sizes[s] for s in capped)
        left = sum(w for s, w in weight.items() if s not in capped)
        above = {s for s in sizes if s not in capped and weight[s] * rest / left > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rest / left for s in sizes}
        capped |= above


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    data = some_documents(seed)
    df = spark.createDataFrame([(*r, "s", "t", "a", "r", "c") for r in data], DOCS)
    told = mixing.mix(df).collect()
    assert sorted(map(repr, told)) == sorted(map(repr, mixing.mix(df.repartition(7)).collect()))
    count = lambda t: len((t or "").split())
    sizes, largest = Counter(), Counter()
    for _, t, s in data:
        sizes[s] += count(t)
        largest[s] = max(largest[s], count(t))
    targets = plain_targets(sizes)
    assert sorted(repr((i, count(t), sizes[s], targets[s])) for i, t, s in data) == sorted(repr(tuple(r)[:4]) for r in told)
    taken = Counter()
    mixed = mixing.mixed_documents(df)
    assert mixed.dtypes == df.dtypes
    for r in mixed.collect():
        taken[r["source"]] += count(r["text"])
    assert sum(taken.values()) == sum(r["taken"] for r in told)
    assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 2 * r["size"] if r["size"] else r["taken"] == 0 for r in told)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(1, largest[s])


def test_mix_crosses_whole_numbers(spark):
    """Within a source the copies are the whole numbers that offset plus expected copies pass."""
    data = [(k, "w " * 7, "a") for k in range(101)] + [(k, "w " * 3, "b") for k in range(500)]
    df = spark.createDataFrame([(*r, "s", "t", "a", "r", "c") for r in data], DOCS)
    told = mixing.mix(df).collect()
    offset = int(hashlib.md5(b"mix:source:b").hexdigest()[:8], 16) / 2**32
    rows = sorted((hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest(), r) for r in told if r["size"] == 3)
    rate = rows[0][1]["target"] / 1500
    assert [r["taken"] // 3 for _, r in rows] == [math.floor((k + 1) * rate + offset) - math.floor(k * rate + offset) for k in range(500)]


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    blank = spark.createDataFrame([(1, None, "a", *"abcde"), (None, "", None, *"abcde")], DOCS)
    assert sorted(map(repr, map(tuple, mixing.mix(blank).collect()))) == ["(1, 0, 0, 0.0, 0)", "(None, 0, 0, 0.0, 0)"]
