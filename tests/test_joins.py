"""Lookups with one key holding a third of the rows, against a plain dictionary."""

import pytest
from pyspark.sql import functions as F

from quillmill.operators.joins import frequent_first_lookup, hot_keys, salted_lookup

FACTS = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}") for i in range(300)]
LOOKUP = {"hot": 100, **{f"k{i}": i for i in range(8)}}


@pytest.fixture(scope="module")
def frames(spark):
    facts = spark.createDataFrame(FACTS, "id bigint, k string")
    return facts, spark.createDataFrame(list(LOOKUP.items()), "k string, v bigint")


def test_both_lookups_equal_a_dictionary(spark, frames):
    facts, lookup = frames
    want = [(i, LOOKUP.get(k)) for i, k in FACTS]
    for joined in (
        salted_lookup(facts, lookup, "k", "id", salts=4),
        salted_lookup(facts, lookup, "k", "id", salts=1),
        salted_lookup(facts, lookup, "k", "id", salts=4, hot=[]),
        frequent_first_lookup(facts, lookup, "k", "v", F.col("v") >= 100, "id"),
    ):
        assert [(r["id"], r["v"]) for r in joined.orderBy("id").collect()] == want


def test_hot_rows_are_spread_when_nothing_is_broadcast(spark, frames):
    facts, lookup = frames
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_lookup(facts, lookup, "k", "id", salts=16).withColumn("p", F.spark_partition_id())
        hot = joined.filter("k = 'hot'").groupBy("p").count().collect()
        assert len(hot) > 1 and sum(r["count"] for r in hot) == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_lookup_rows_of_hot_keys_are_repeated(spark):
    facts = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id) END AS k").repartition(5)
    lookup = spark.range(6000).selectExpr("concat('k', id) AS k", "id AS v").unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    assert hot_keys(facts, "k") == ["hot"]
    joined = salted_lookup(facts, lookup, "k", "id")
    want = [(i, "hot", -1) if i % 3 == 0 else (i, None, None) if i % 7 == 0 else (i, f"k{i}", i) for i in range(6000)]
    assert [(r["id"], r["k"], r["v"]) for r in joined.orderBy("id").collect()] == want
    # without one to spread, no lookup row is repeated, and rows without a key still do not meet in one task
    assert hot_keys(facts.filter("k <> 'hot'"), "k") == [] == hot_keys(facts.limit(0), "k") == hot_keys(facts.filter("k IS NULL"), "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = joined.withColumn("p", F.spark_partition_id()).filter("k IS NULL").select("p").distinct().count()
        assert tasks > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
