"""Secret scan by ownership frequency, in DataFrame functions alone.

Every candidate (a password-like assignment, an access key, a long hexadecimal run, an opaque token) is
hashed by value, and for each value the distinct owners and repositories over the whole corpus are
counted. A value that several owners hold, or that is copied through many repositories of few owners, is an example; one
that few hold, and that looks random, is taken for a live credential. Opaque tokens have no telling context, so they count only when live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm import common
from quillmill.session import written

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the runs of 16 characters and more of AKIA[A-Z0-9]+
HEX = r"[0-9a-f]{32,}"
OPAQUE = r"[A-Za-z0-9_-]{24,}"
KINDS = ["assign", "access", "hex", "opaque"]
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
PLACEHOLDERS = r"(?i)example|changeme|placeholder|your|dummy|xxxx|0000000|1234567"

#: A value that this many owners hold is an example.
EXAMPLE_OWNERS = 3
#: So is one that stands in this many repositories, whoever owns them.
EXAMPLE_REPOS = 4
#: A value of fewer different characters than this does not look random.
LEAST_CHARACTERS = 6

SPAN = "array<struct<start:int,k:int,stop:int,value:string>>"


def _spans(k: int, pattern: str, may_match: Column, keep, value_group: int = 0) -> Column:
    """Matches of ``pattern`` with code point offsets, leftmost and non-overlapping.

    ``split`` gives the pieces between the matches, so offsets are running sums of lengths. Patterns run
    only where ``may_match`` holds; it must hold wherever the pattern matches.
    """
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(found.alias("m"), values.alias("v"), F.slice(gaps, 2, F.size(gaps)).alias("gap"))
    # the zipped fields are named by position where their inputs have no name of their own
    steps = steps.cast("array<struct<m:string,v:string,gap:int>>")

    def step(seen, x):
        stop = seen["at"] + F.length(x["m"])
        span = F.struct(
            seen["at"].alias("start"), F.lit(k).alias("k"), stop.alias("stop"), x["v"].alias("value"),
        )
        return F.struct(
            (stop + x["gap"]).alias("at"),
            F.when(keep(x["v"]), F.concat(seen["out"], F.array(span))).otherwise(seen["out"]).cast(SPAN).alias("out"),
        )

    start = F.struct(F.element_at(gaps, 1).alias("at"), F.array().cast(SPAN).alias("out"))
    spans = F.aggregate(steps, start, step, lambda seen: seen["out"])
    return F.when(may_match, spans).otherwise(F.array().cast(SPAN))


def _may_hold() -> list[Column]:
    """Which texts may have a candidate, by kind: all that have one."""
    named = F.lit(False)
    for word in KEYWORDS:
        named = named | F.contains(F.lower("text"), F.lit(word))
    return [named, F.contains("text", F.lit("AKIA")), F.col("text").rlike(HEX), F.col("text").rlike(OPAQUE)]


def candidates(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """doc_id, row_key, owner, repo and ``spans`` (by start, then kind) of every row; one pass, no shuffle.

    A repository is named within its owner. A null owner or repository is the empty name: all nulls are
    one owner. A null text has no spans.
    """
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repo"),
    )
    may = _may_hold()
    always = lambda v: F.lit(True)
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    spans = F.concat(
        _spans(0, ASSIGN, may[0], lambda v: F.length(v) >= 8, value_group=2),
        _spans(1, ACCESS, may[1], always),
        _spans(2, HEX, may[2], always),
        _spans(3, OPAQUE, may[3], mixed),
    )
    return base.select("doc_id", common.row_key().alias("row_key"), "owner", "repo", F.array_sort(spans).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repos of each candidate value over the corpus.

    Rows are reduced by (value, owner, repository) before they are sent, so a value that a third of the
    corpus holds costs each task one row per owner and repository.
    """
    values = found.select(F.explode(F.array_distinct(F.transform("spans", lambda s: F.sha2(s["value"], 256)))).alias("value_hash"), "owner", "repo")
    by_owner = values.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def looks_random(value: Column) -> Column:
    return (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_CHARACTERS) & ~value.rlike(PLACEHOLDERS)


def judged(found: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """doc_id, row_key and ``spans`` (with n_owners, n_repos, live) of the rows of ``found`` that keep any span.

    Base spans all stay, with their verdict; opaque tokens stay if live and clear of the base spans.
    """
    spans = found.filter(F.size("spans") > 0).select("doc_id", "row_key", F.explode(F.array_distinct("spans")).alias("s"), "spans")
    clear = ~F.exists("spans", lambda o: (o["k"] < 3) & (o["start"] < F.col("s.stop")) & (F.col("s.start") < o["stop"]))
    spans = spans.withColumn("usable", (F.col("s.k") < 3) | clear).filter("usable").select("doc_id", "row_key", "s")
    counted = spans.withColumn("value_hash", F.sha2(F.col("s.value"), 256)).join(ownership(found), "value_hash")
    live = (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos) & looks_random(F.col("s.value"))
    kept = counted.withColumn("live", live).filter((F.col("s.k") < 3) | F.col("live"))
    return kept.groupBy("doc_id", "row_key").agg(
        # repeated rows give the same spans again
        F.array_sort(F.collect_set(F.struct("s.start", "s.k", "s.stop", "n_owners", "n_repos", "live"))).alias("spans")
    )


def _of_kind(k: int):
    return lambda s: s["k"] == k


def _named(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["stop"])), ",")


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all spans, verdicts.

    Tables with no rows give no rows; a text without spans has counts of 0 and the digest of the empty string.
    """
    found = written(candidates(docs, owner, repository), "secret-candidates")
    verdicts = judged(found)
    left = found.select("doc_id", "row_key")
    rows = left.join(verdicts, common.same_row(left, verdicts), "left").select(
        left["doc_id"], F.coalesce(verdicts["spans"], F.array()).cast("array<struct<start:int,k:int,stop:int,n_owners:bigint,n_repos:bigint,live:boolean>>").alias("spans")
    )
    of = lambda test: F.size(F.filter("spans", test)).cast("bigint")
    base = F.filter("spans", lambda s: s["k"] < 3)
    return rows.select(
        "doc_id", *[of(_of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"),
        of(lambda s: s["live"]).alias("n_live"), of(lambda s: ~s["live"]).alias("n_example"),
        # for each span, in their order, how many owners and repositories hold its value
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["n_owners"], s["n_repos"])), ",").alias("held_by"),
    )


def redacted(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """The rows of ``docs`` with live secrets replaced by ``[SECRET]``; examples and clean texts stay as they are.

    Only texts with a candidate are shuffled, to meet their verdicts. ``n_chars``, if there, follows the new text.
    """
    found = written(candidates(docs, owner, repository), "secret-candidates")
    verdicts = judged(found).select("doc_id", "row_key", F.filter("spans", lambda s: s["live"]).alias("cuts")).filter(F.size("cuts") > 0)
    named, access, long_hex, opaque = _may_hold()
    suspect = F.coalesce(named | access | long_hex | opaque, F.lit(False))
    rows = common.packed(docs.filter(suspect))
    met = rows.join(verdicts, common.same_row(rows, verdicts), "left").select("kept_row", "cuts")
    text = F.col("kept_row.text")

    def step(seen, s):
        skip = F.greatest(seen["at"], s["stop"])
        fresh = s["start"] >= seen["at"]
        piece = F.concat(seen["out"], text.substr(seen["at"] + 1, s["start"] - seen["at"]), F.lit("[SECRET]"))
        return F.struct(skip.alias("at"), F.when(fresh, piece).otherwise(seen["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("cuts", start, step, lambda seen: F.concat(seen["out"], text.substr(seen["at"] + 1, F.length(text))))
    new = F.when(F.col("cuts").isNotNull(), clean).otherwise(text)
    changed = {"text": new} | ({"n_chars": F.length(new).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return docs.filter(~suspect).unionByName(met.select(*[changed.get(c, F.col("kept_row")[c]).alias(c) for c in docs.columns]))
