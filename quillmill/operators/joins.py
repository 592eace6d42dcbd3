"""Lookup joins that hold up when one key has very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A key is hot that holds at least this share of the facts; there cannot be more hot keys than one over it
HOT_SHARE = 0.005
# Keys that a task's sketch tracks: counts are off by much less than the share
TRACKED_KEYS = 8192


def hot_keys(facts: DataFrame, key: str) -> list:
    """The keys that hold ``HOT_SHARE`` of the facts or more, by a sketch of fixed size: one pass over the key column."""
    most = int(1 / HOT_SHARE)
    known = facts.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    found = known.agg(F.expr(f"approx_top_k(k, {most}, {TRACKED_KEYS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in found["top"] or () if item["count"] >= max(2.0, HOT_SHARE * found["n"])]


def salted_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, spread_by: str, salts: int = 16, hot: Sequence | None = None
) -> DataFrame:
    """Left join of ``facts`` with ``lookup`` (one row per ``key``), the rows of hot keys spread over ``salts`` tasks.

    Facts of a hot key are spread by a hash of ``spread_by``, and only the lookup rows of hot keys are repeated ``salts`` times: the rest
    of a lookup is sent once, however large it is. ``hot`` has the keys if they are known, else ``hot_keys`` finds them. Rows without
    a key match nothing and are spread over all tasks, instead of meeting in one.
    """
    if salts <= 1:
        return facts.join(lookup, key, "left")
    hot = hot_keys(facts, key) if hot is None else hot
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False)) if hot else F.lit(False)
    spread = F.xxhash64(spread_by)
    salt = F.when(F.col(key).isNull(), spread).when(is_hot, F.pmod(spread, F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    last = F.when(is_hot, F.lit(salts - 1)).otherwise(0).cast("bigint")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return facts.withColumn("_salt", salt).join(repeated, [key, "_salt"], "left").drop("_salt")


def frequent_first_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, value: str, frequent: Column, spread_by: str
) -> DataFrame:
    """Left join of ``facts`` with ``lookup (key, value)`` where the keys that many facts have are known.

    Keys for which ``frequent`` holds are broadcast; the caller sees to it that they are few
    whatever the size of the data. Facts settled that way go through the second join under a
    key that matches nothing and spreads them, so no task gets a frequent key's rows.
    """
    common = lookup.filter(frequent).select(key, F.col(value).alias("_common"))
    rare = lookup.filter(~frequent).select(F.col(key).alias("_rare_key"), F.col(value).alias("_rare"))
    settled = facts.join(F.broadcast(common), key, "left")
    spread = F.concat(F.lit("\x00"), F.xxhash64(spread_by, key).cast("string"))
    second = F.when(F.col("_common").isNull(), F.col(key)).otherwise(spread)
    joined = settled.withColumn("_second", second).join(rare, F.col("_second") == F.col("_rare_key"), "left")
    return joined.withColumn(value, F.coalesce("_common", "_rare")).drop("_second", "_rare_key", "_common", "_rare")
