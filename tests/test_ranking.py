import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmill.operators import ranking


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def brute(query, sentences):
    n = len(sentences)
    df = Counter(w for s in sentences for w in set(words(s)))
    tf = Counter(words(query))
    weight = {w: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in tf.items()}
    length = math.sqrt(sum(w * w for w in weight.values()))
    out = []
    for s in sentences:
        own = set(words(s))
        out.append(sum(weight[w] for w in own if w in weight) / length / math.sqrt(len(own)) if own else 0.0)
    return out


SENTENCES = [
    "The harbour of Kiel handles ferries, yachts and a population of very loud gulls.",
    "Kiel has a market on the square twice a week.",
    "Some forty thousand students of Kiel live near the harbour or in the villages around it.",
    "Nothing to see", "", "Kiel", "Kiel", "population population kiel",
]
QUERY = "how many students live in Kiel: the population of Kiel"


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(list(enumerate(SENTENCES)), "ord bigint, sentence string").repartition(3)


def test_ranking_equals_brute_force(sentences):
    scores = brute(QUERY, SENTENCES)
    got = ranking.rank_sentences(sentences, QUERY).collect()
    want = sorted(range(len(SENTENCES)), key=lambda i: (-round(scores[i], 9), i))
    assert [r["ord"] for r in got] == want
    assert all(abs(r["score"] - scores[r["ord"]]) < 1e-8 for r in got)
    kept = ranking.semantic_filter(sentences, QUERY, threshold=got[2]["score"]).collect()
    assert [r["ord"] for r in kept] == [r["ord"] for r in got if r["score"] >= got[2]["score"]]
    ranks = ranking.rank_documents(sentences, QUERY, text="sentence").collect()
    assert [r["corpus_id"] for r in ranks] == want


def test_queries_without_known_words(sentences):
    assert {r["score"] for r in ranking.rank_sentences(sentences, "zzz").collect()} == {0.0}
    assert {r["score"] for r in ranking.rank_sentences(sentences, "?!").collect()} == {0.0}


def best_of(asked, texts, k):
    want = []
    for number, query in asked:
        scores = [round(x, 9) for x in brute(query, texts)] if words(query) else [0.0] * len(texts)
        best = sorted((i for i in range(len(texts)) if scores[i] > 0), key=lambda i: (-scores[i], i))[:k]
        want += [(number, n + 1, i, scores[i]) for n, i in enumerate(best)]
    return sorted(want)


def found(df):
    return sorted((r["query_id"], r["rank"], r["ord"], r["score"]) for r in df.collect())


def same(got, want):
    return [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 1e-8 for g, w in zip(got, want))


@pytest.mark.parametrize("k", [1, 3, 20])
def test_many_queries_equal_brute_force(spark, sentences, k):
    asked = [(7, QUERY), (3, "registered clubs"), (5, "zzz"), (9, ""), (2, "kiel"), (1, "Kiel students zzz kiel")]
    queries = spark.createDataFrame(asked, "query_id bigint, query string")
    assert same(found(ranking.top_sentences(sentences, queries, k=k)), best_of(asked, SENTENCES, k))


def test_a_word_of_all_sentences_and_queries_brings_few_candidates(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(["the"] + [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(rng.randint(2, 9))]) for _ in range(600)]
    texts += ["the same line again"] * 300 + [None, "", "the"]
    asked = [(n, "the " + " ".join(rng.sample(texts[n].split(), 2) + [f"w{n}"])) for n in range(40)] + [(99, "the")]
    rows = spark.createDataFrame(list(enumerate(texts)), "ord bigint, sentence string").repartition(4)
    queries = spark.createDataFrame(asked, "query_id bigint, query string")
    pairs, scored = [], ranking._scored
    monkeypatch.setattr(ranking, "_scored", lambda p, *rest: (pairs.append(p), scored(p, *rest))[1])
    got = found(ranking.top_sentences(rows, queries, k=4))
    assert same(got, best_of(asked, [t or "" for t in texts], 4))
    # every query shares a word with 901 sentences
    assert pairs[1].count() < 0.1 * len(asked) * len(texts)
    named = rows.select(F.format_string("s%04d", "ord").alias("ord"), "sentence")
    by_name = ranking.top_sentences(named, queries.select(F.format_string("q%02d", "query_id").alias("query_id"), "query"), k=4)
    assert [(f"q{q:02d}", r, f"s{o:04d}") for q, r, o, _ in got] == [g[:3] for g in found(by_name)]
    assert ranking.top_sentences(rows.limit(0), queries, k=4).count() == ranking.top_sentences(rows, queries.limit(0), k=4).count() == 0


def test_pair_model_is_used_in_batches(spark, sentences):
    def load():
        def predict(queries, texts):
            return [len(set(q.lower().split()) & set(t.lower().split())) - 0.5 for q, t in zip(queries, texts)]

        return predict

    scorer = ranking.model_scorer(load)
    got = ranking.rank_sentences(sentences, "kiel population", scorer=scorer).collect()
    assert [(r["ord"], r["score"]) for r in got[:2]] == [(0, 1.5), (7, 1.5)] and got[2]["score"] == 0.5
    one = ranking.rank_sentence(spark, "a b", "b c", scorer=scorer).first()
    assert one["score"] == 0.5
    assert ranking.rank_sentence(spark, "kiel", "Kiel is big").first()["score"] > 0


def test_pairs_score_as_one_sentence_does(spark):
    pairs = [("kiel kiel gulls", "Kiel is big"), ("", "a b"), ("zzz", "a b"), ("a", ""), (None, "a"), ("a", None), ("b a", "a a b c")]
    got = ranking.rank_pairs(spark.createDataFrame(pairs, "query string, sentence string")).collect()
    for (query, sentence), row in zip(pairs, got):
        want = ranking.rank_sentence(spark, query, sentence).first()["score"] if query and sentence else 0.0
        assert abs(row["score"] - want) < 1e-8 and (row["query"], row["sentence"]) == (query, sentence)
    assert got[0]["score"] > 0 and got[-1]["score"] == round(math.sqrt(2 / 3), 9)
