import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillmill.operators import fuzzy
from quillmill.operators.components import component_labels


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def grouped(titles, ratio):
    """The first title of every group, by looking at all pairs."""
    text = {}
    for k, t in titles:
        words = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        text[k] = " ".join(words)
    firsts = {}
    for k in sorted(text):
        if text[k]:
            firsts.setdefault(text[k], k)
    label = {k: k for k in firsts.values()}
    changed = True
    links = [(i, j) for s, i in firsts.items() for t, j in firsts.items() if i < j and distance(s, t) <= int(max(len(s), len(t)) * (1 - ratio) + 1e-9)]
    while changed:
        changed = False
        for i, j in links:
            least = min(label[i], label[j])
            if label[i] != least or label[j] != least:
                label[i] = label[j] = least
                changed = True
    return sorted([k for k in label if label[k] == k] + [k for k in text if not text[k]])


def some_titles(seed, n=300):
    rng = random.Random(seed)
    base = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    titles = []
    for k in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.choice([0, 1])] = rng.choice(["", "x", "é", " "])
        t = "".join(t)
        titles.append((k, rng.choice([t, t.upper(), t + "!", "  " + t])))
    return titles + [(n, None), (n + 1, ""), (n + 2, "?!"), (n + 3, "a"), (n + 4, "b"), (n + 5, "a"), (n + 6, "the the the the"), (n + 7, "the the the thee")]


@pytest.mark.parametrize("ratio", [0.85, 0.7])
def test_similar_titles_are_merged(spark, ratio):
    titles = some_titles(int(ratio * 100))
    df = spark.createDataFrame([(t, k, "x") for k, t in titles], "title string, ord bigint, text string")
    kept = fuzzy.merge_similar_titles(df, ratio=ratio)
    assert kept.columns == df.columns
    assert sorted(r["ord"] for r in kept.collect()) == grouped(titles, ratio)


def test_titles_that_share_their_words(spark):
    """Every title has the same frequent grams; equal titles are very many."""
    titles = [(k, f"the study of the results of the trial number {k % 50:04d}{k % 50:04d}{k % 50:04d}{k % 50:04d}") for k in range(2000)]
    df = spark.createDataFrame([(t, k) for k, t in titles], "title string, ord bigint")
    assert sorted(r["ord"] for r in fuzzy.merge_similar_titles(df).collect()) == grouped(titles, 0.85)


def test_no_titles(spark):
    assert fuzzy.merge_similar_titles(spark.createDataFrame([], "title string, ord bigint")).collect() == []


def test_components(spark):
    chain = [(k, k + 1) for k in range(200, 300)] + [(5, 9), (9, 7), (7, 5), (1, 1), (1000, 5)] + [(2000, 2000 + k) for k in range(1, 500)]
    random.Random(3).shuffle(chain)
    got = {r["node"]: r["label"] for r in component_labels(spark.createDataFrame(chain, "x bigint, y bigint"), "x", "y").collect()}
    want = {k: 200 for k in range(200, 301)} | {k: 5 for k in (5, 7, 9, 1000)} | {k: 2000 for k in range(2000, 2500)}
    assert got == want


def test_marks_rule_out_far_pairs_and_no_near_one(spark):
    """Random pairs a few edits apart are never ruled out; unlike texts of the same letters' kind are, before they are written."""
    draw = random.Random(5)
    rows = []
    for n in range(300):
        left = "".join(draw.choices("abcde fghé", k=draw.randint(1, 120)))
        right = list(left)
        for _ in range(draw.randint(0, 12)):
            at, new = draw.randrange(len(right) + 1), draw.choice("abcdex")
            right[at:at + draw.randint(0, 1)] = [new] * draw.randint(0, 1)
        rows.append((n, *sorted((left, "".join(right)), key=len, reverse=True)))
    df = spark.createDataFrame(rows, "n int, one string, two string").filter("two <> ''")
    sides = [df.select("n", F.length(c).alias("length"), fuzzy._marks(c).alias("m")).select("n", "length", "m.*") for c in ("one", "two")]
    left = sides[0].select("n", *[F.col(c).alias(f"_{c}") for c in sides[0].columns if c != "n"])
    met = left.join(sides[1], "n").join(df, "n").withColumn("edits", F.levenshtein("one", "two"))
    assert met.filter(~fuzzy._may_be_near("_", "", F.col("edits"))).count() == 0
    far = spark.createDataFrame([("abcdefgh" * 5, "stuvwxyz" * 5)], "one string, two string")
    marked = far.select(F.length("one").alias("_length"), F.length("two").alias("length"), fuzzy._marks("one").alias("o"), fuzzy._marks("two").alias("m"))
    both = marked.select("*", *[F.col(f"o.{c}").alias(f"_{c}") for c in fuzzy._CHARACTER_MARKS + fuzzy._GRAM_MARKS], "m.*")
    assert both.select(fuzzy._may_be_near("_", "", F.lit(6))).first()[0] is False


def block(texts):
    """Texts as a packed block that is opened again."""
    marks = fuzzy._marks.func(pd.Series(texts))
    titles = pd.DataFrame({"block": 0, "id": range(len(texts)), "text": texts, "length": [len(t) for t in texts]})
    return fuzzy._Block(*fuzzy._packed(pd.concat([titles, marks], axis=1)).iloc[0][1:])


def test_distance_in_bits():
    draw = random.Random(2)
    for _ in range(200):
        one, two = ("".join(draw.choices("abé 𝄞", k=draw.randint(1, 90))) for _ in range(2))
        assert fuzzy._distance(one, two) == distance(one, two)


def test_long_unlike_texts_are_not_compared(monkeypatch):
    """Long texts have all grams that there are, so it is their numbers that tell them apart before any edit distance."""
    draw = random.Random(7)
    words = ["".join(draw.choices("aeionrst", k=draw.randint(2, 5))) for _ in range(400)]
    texts = [" ".join(draw.choices(draw.sample(words, 40), k=300)) for _ in range(30)]
    near = [t[:20] + "x" + t[20:700] + t[720:] for t in texts[:10]]
    asked, distance_of = [], fuzzy._distance
    monkeypatch.setattr(fuzzy, "_distance", lambda one, other: asked.append(1) or distance_of(one, other))
    all_texts = block(texts + near)
    links = [sorted((all_texts.ids[a], all_texts.ids[b])) for a, b in fuzzy._links(all_texts, all_texts, 0.85)]
    assert sorted(links) == [[k, 30 + k] for k in range(10)]
    met = sum(len(i) for i, _ in fuzzy._met(all_texts, all_texts, 0.85))
    assert len(asked) < 20 < 300 < met


def test_a_group_of_near_titles_gives_a_link_for_each():
    texts = [f"annual report of the society for the study of rivers number {k:03d}" for k in range(300)]
    one, two = block(texts[:200]), block(texts[200:])
    assert len(fuzzy._links(one, one, 0.85)) == 199
    assert len(fuzzy._links(one, two, 0.85)) == 299


def test_counts_and_marks_rule_out_no_near_pair():
    draw = random.Random(11)
    left, right = [], []
    for _ in range(150):
        text = "".join(draw.choices("abcde fghé", k=draw.choice([3, 9, 30, 150, 900])))
        edits, other = int(fuzzy._allowed(len(text), 0.85)), list(text)
        for _ in range(edits):
            at, new = draw.randrange(len(other)), draw.choice("abcdex")
            other[at:at + draw.randint(0, 1)] = [new] * draw.randint(0, 1)
            other = other or ["a"]
        if len(other) <= len(text):
            left.append(text)
            right.append("".join(other))
    longer, shorter = block(left), block(right)
    wanted = {(a, b) for b, t in enumerate(sorted(left, key=len)) for a, s in enumerate(sorted(right, key=len))
              if len(s) <= len(t) and abs(len(s) - len(t)) <= 140 and fuzzy._distance(t, s) <= fuzzy._allowed(len(t), 0.85)}
    met = [fuzzy._counted(shorter, longer, i, j, 0.85) for i, j in fuzzy._met(shorter, longer, 0.85)]
    assert wanted <= {(a, b) for i, j in met for a, b in zip(i.tolist(), j.tolist())} and len(wanted) > 60


def test_titles_of_many_blocks(spark, monkeypatch):
    """Blocks of few titles, and parts of one length."""
    monkeypatch.setattr(fuzzy, "_LEAST_ROWS", 12)
    titles = some_titles(12, n=60)
    df = spark.createDataFrame([(t, k) for k, t in titles], "title string, ord bigint")
    assert sorted(r["ord"] for r in fuzzy.merge_similar_titles(df).collect()) == grouped(titles, 0.85)


def test_blocks_meet_all_that_fit():
    draw = random.Random(1)
    for ratio in (0.5, 0.85, 1.0):
        lengths = sorted({draw.randint(1, 400): draw.randint(1, 3000) for _ in range(100)}.items())
        dealt, blocks = fuzzy._blocks(lengths, ratio)
        of = {length: range(first, first + parts) for length, first, parts in dealt}
        meet = {(x, y) for y, lowest, _ in blocks for x in range(lowest, y + 1)}
        assert meet == {(x, y) for x, _, highest in blocks for y in range(x, highest + 1)}
        for long, _ in lengths:
            for short, _ in lengths:
                if long - int(fuzzy._allowed(long, ratio)) <= short <= long:
                    assert all((min(x, y), max(x, y)) in meet for x in of[short] for y in of[long])


def test_parts_that_no_title_falls_to():
    titles = pd.DataFrame([[0, 1, [1], b"", b"", ""]])
    assert fuzzy._linking(0.85)((0, 1), titles, titles.iloc[:0]).empty and fuzzy._linking(0.85)((0, 1), titles.iloc[:0], titles).empty
