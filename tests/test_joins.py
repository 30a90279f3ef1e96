"""Joins and ranks under one key that holds half of all rows."""

import random

from pyspark.sql import functions as F

from agorasift.functions import joins
from agorasift.functions.ranks import ranked


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    many = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 40}") for i in range(2000)] + [(-1, None)], "i int, k string")
    one = spark.createDataFrame([("hot", 1), *[(f"k{i}", 2) for i in range(0, 30)]], "k string, v int")
    for how in ("inner", "left"):
        got = joins.join_hot(many, one, "k", F.col("i"), how)
        assert got.columns == ["k", "i", "v"]
        assert sorted(map(str, got.collect())) == sorted(map(str, many.join(one, "k", how).select("k", "i", "v").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = joins.join_hot(many, one, "k", F.col("i")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert max(r["count"] for r in rows) < 0.45 * sum(r["count"] for r in rows)  # four partitions


def test_ranks_of_a_hot_group(spark):
    rnd = random.Random(4)
    rows = [("hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice([None, 0.5, 0.25]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, q double, i int")
    got = {r["i"]: r["rank"] for r in ranked(df, ["g"], [F.col("q").desc_nulls_last(), F.col("i")]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {r[2]: k + 1 for k, r in enumerate(mine)}
    assert got == want
