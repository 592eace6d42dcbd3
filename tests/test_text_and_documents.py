import random

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import documents as docs


def test_whitespace_like_python_split(spark):
    texts = ["a b", " \t a \n\n b\x85c ", "x\x1c\x1dy", " ", "", "plain", "tab\x0bv", "😀 　 é", "​ z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(tx.collapse_whitespace(F.col("t"))).collect()]
    assert got == [" ".join(t.split()) for t in texts]


def test_slices_and_tokens_count_code_points(spark):
    df = spark.createDataFrame([("a😀b" * 100,)], "t string")
    t = "a😀b" * 100
    row = df.select(tx.char_slice(F.col("t"), 5, 20), tx.token_estimate(F.col("t"))).first()
    assert row[0] == t[5:20] and row[1] == 75


@pytest.mark.parametrize("length", [0, 1, 199, 200, 201, 1000, 3999, 4000, 4001, 8000, 30001])
def test_chunks_join_to_the_text(spark, length):
    text = "".join(random.Random(length).choice("ab\n😀é ") for _ in range(length))
    df = spark.createDataFrame([(1, text)], "id bigint, text string")
    chunks = [r["chunk"] for r in docs.chunk_text(df, "text", "id").orderBy("chunk_no").collect()]
    assert chunks == [text[i : i + 4000] for i in range(0, length, 4000)]
    got = {(r["embedding_type"], r["part_no"]): r["section_text"] for r in docs.sections(df, "text", "id").collect()}
    want = {("title", 0): text[:200], ("abstract", 0): text[200:1000]}
    want |= {("full_text", k): text[i : i + 30000] for k, i in enumerate(range(0, length, 30000))}
    assert got == {k: v for k, v in want.items() if v.strip()}


@pytest.mark.parametrize("size", [1, 7, 40])
def test_assembled_chunks_equal_the_joined_text(spark, size):
    rnd = random.Random(size)
    pages = []
    want = {}
    for doc in range(6):
        texts = []
        for no in range(rnd.randint(1, 30)):
            words = ["".join(rnd.choice("abc😀") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(0, 12))]
            text = rnd.choice([None, " ", " ".join(words), "\n\t" + "  ".join(words)])
            texts.append(text)
            pages.append((doc, no, text))
        joined = " ".join("\n".join(t or "" for t in texts).split())
        want[doc] = [joined[i : i + size] for i in range(0, len(joined), size)]
    rnd.shuffle(pages)
    df = spark.createDataFrame(pages, "doc bigint, page int, t string")
    got = {doc: [] for doc in want}
    for r in docs.assemble_chunks(df, "doc", "page", "t", size=size, range_pages=4).orderBy("doc", "chunk_no").collect():
        assert r["chunk_no"] == len(got[r["doc"]])
        got[r["doc"]].append(r["chunk"])
    assert got == want
    chunks = docs.assemble_chunks(df, "doc", "page", "t", size=size, range_pages=4)
    parts = {(r["doc"], r["part_no"]): r["text"] for r in docs.text_parts(chunks, "doc", chars=50, size=size).collect()}
    whole = {d: "".join(c) for d, c in want.items()}
    assert parts == {(d, k): t[i : i + 50] for d, t in whole.items() for k, i in enumerate(range(0, len(t), 50))}


def test_empty_texts_are_rejected(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None), (4, " \n")], "id bigint, t string")
    kept, rejects = docs.split_empty(df, "t", "id")
    assert rows(kept) == [(1, "x")]
    assert rows(rejects) == [("parse", k, "empty_text") for k in ("2", "3", "4")]


def test_prompts(spark):
    df = spark.createDataFrame([(1, "y" * 4001), (2, "")], "id bigint, t string")
    got = {(r["summary_type"], r["chunk_no"]): r for r in docs.prompts(df, "t", "id").collect()}
    assert set(got) == {(kind, no) for kind in ("executive", "key_findings", "methodology", "implications") for no in (0, 1)}
    assert got["executive", 0]["model"] == "gpt-4o" and got["implications", 1]["model"] == "gpt-4o-mini"
    assert all(r["prompt"].endswith("\n\n" + "y" * (4000 if no == 0 else 1)) and r["max_tokens"] == 500 for (_, no), r in got.items())


def test_summaries_pick_cued_and_frequent_sentences_in_order(spark):
    text = "Alpha beta. We measured a sample. Alpha alpha beta! Gamma? Results showed alpha. Future delta."
    df = spark.createDataFrame([(1, text)], "id bigint, t string")
    got = {r["summary_type"]: r["content"] for r in docs.extractive_summaries(df, "t", "id", top=2).collect()}
    assert got["executive"] == "Alpha beta. Alpha alpha beta!"
    assert got["key_findings"] == "Alpha alpha beta! Results showed alpha."
    assert got["methodology"] == "We measured a sample. Alpha alpha beta!"
    assert got["implications"] == "Alpha alpha beta! Future delta."


def test_summaries_read_the_whole_text(spark):
    text = "Calm words. " * 800 + "Results showed late findings here. " * 3
    df = spark.createDataFrame([(1, text), (2, "... !!"), (3, None)], "id bigint, t string")
    got = {(r["id"], r["summary_type"]): r["content"] for r in docs.extractive_summaries(df, "t", "id", top=2).collect()}
    assert set(got) == {(1, kind) for kind in docs.SUMMARY_CUES}
    assert got[1, "key_findings"] == "Results showed late findings here. Results showed late findings here."
    assert got[1, "executive"] == "Calm words. Calm words."


def test_incomplete_summaries_reject_the_document(spark, rows):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (2, "b", None)], "id bigint, summary_type string, content string")
    kept, rejects = docs.keep_complete(df, "id", wanted=2)
    assert rows(kept.select("id").distinct()) == [(1,)]
    assert rows(rejects) == [("summarise", "2", "summary_failed")]
    among = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    assert rows(docs.keep_complete(df, "id", 2, among)[1]) == [("summarise", k, "summary_failed") for k in ("2", "3")]


def test_metadata_extraction(spark):
    text = (
        "Abstract: Creatine helps.\nAuthors: A. One, B. Two\nJournal of Sports Science, 2023-01-05. A randomized controlled trial "
        "with 1,200 participants over 12 weeks at the University of Somewhere. Cited by 42. creatine creatine"
    )
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "id bigint, t string")
    got = {r["id"]: r["metadata"] for r in docs.extract_metadata(df, "t", "id").collect()}
    m = got[1]
    assert m["abstract"] == "Creatine helps." and m["citations"] == 42 and m["publication_date"] == "2023-01-05"
    assert m["journal"] == "Journal of Sports Science" and m["authors"] == ["A. One, B. Two"]
    assert m["institutions"] == ["University of Somewhere"] and m["methodology"] == "randomized controlled trial"
    assert m["sample_size"] == 1200 and m["duration"] == "12 weeks" and m["keywords"][0] == "creatine"
    assert got[2]["citations"] is None and got[2]["authors"] is None
    values = {r["key"]: r["value"] for r in docs.metadata_rows(docs.extract_metadata(df, "t", "id"), "id").filter("paper_id = 1").collect()}
    assert values["citations"] == "42" and values["duration"] == '"12 weeks"' and values["authors"] == '["A. One, B. Two"]'


def test_html(spark):
    html = "<html><style>p{}</style><script>var t='</p>';</script><p>A &amp; B<br>c</p><!-- no --></html>"
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(tx.strip_html(F.col("h"))).first()[0] == "A & B c"


def test_summaries_make_their_sentences_once(spark):
    """The array of scored sentences is made by one step of the plan; a filter on it had it made a second time."""
    df = spark.createDataFrame([(1, "One fish. Two fish."), (2, " .. "), (3, None)], "id int, t string")
    found = docs.extractive_summaries(df, "t", "id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_zip(") == 1
    assert {r["id"] for r in found.collect()} == {1}


def test_blank_texts_are_those_that_collapse_to_nothing(spark):
    texts = ["", " ", "\t\x0b\x1c\x85\u00a0\u2028\u3000", "\u200b", " a", None, "\n.\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(tx.is_blank(F.col("t")), F.length(tx.collapse_whitespace(F.col("t"))) == 0).collect()
    assert [tuple(r) for r in got] == [(True, True)] * 3 + [(False, False)] * 2 + [(None, None), (False, False)]


def test_frequent_words_of_a_text_are_counted_in_its_row(spark, rows):
    """Only texts that share their keys have words to shuffle."""
    texts = [
        ("a", "delta delta gamma ALPHA alpha, betas betas kappa tiny tiny tiny zetas"), ("b", "gamma gamma alpha"), ("b", "alpha alpha"),
        (None, "omega"), (None, "gamma gamma"), ("c", "four tiny"), ("d", None), ("e", "größe groß \U0001d533\U0001d533\U0001d533\U0001d533\U0001d533"),
    ]
    found = docs.frequent_words(spark.createDataFrame(texts, "k string, t string"), "t", "k")
    assert {r["k"]: r["keywords"] for r in found.collect()} == {
        "a": ["alpha", "betas", "delta", "gamma", "kappa"], "b": ["alpha", "gamma"], None: ["gamma", "omega"],
        "e": ["größe", "\U0001d533" * 5],
    }
    assert "_most_frequent" in found._jdf.queryExecution().optimizedPlan().toString()
