"""Splits that keep related records together (problem 5).

Ties between authors (one record under several authors, accounts of one person or operator) become
edges; :func:`components` contracts them to a spanning forest, which can be persisted. Each root is
one indivisible group, sized by its records. Groups are stratified by size band; inside a band they
are dealt systematically along the running total of their sizes, so each band meets the
proportions, and the few groups that hold a noticeable share of all records are dealt first, the
largest to the split with most room.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorasift.functions.joins import join_hot
from agorasift.llm.components import components

#: Values of ``operator`` that name nobody.
PLACEHOLDERS = ("", "unknown", "none", "n/a", "na", "null", "self", "-", "?", "other", "tbd", "nil", "undefined", "anonymous")
#: A group with more than this share of all records is dealt on its own; there are at most 1000 such groups.
LARGE_SHARE = 0.001
#: Groups of one bucket, about, while running totals are built.
BUCKET_GROUPS = 50_000


def _operator(meta: Column, path: str) -> Column:
    clean = F.lower(F.regexp_replace(F.get_json_object(meta, path), r"(?U)^\s+|\s+$", ""))
    return F.when(~clean.isin(*PLACEHOLDERS), clean)


def author_edges(tweets: DataFrame, users: DataFrame) -> DataFrame:
    """Edges ``a, b`` between authors: shared records, renamed or further accounts, one operator.

    Operators become nodes of their own (``op:`` + name without case and padding), so an operator
    of many accounts costs one edge per account. Metadata that is no JSON object gives no edge.
    """
    rows = tweets.select("tweet_id", F.col("author_id_hash").alias("author")).where("tweet_id is not null and author is not null")
    code = F.xxhash64("author")
    shared = rows.groupBy("tweet_id").agg(F.min(code).alias("lo"), F.max(code).alias("hi")).where("lo <> hi").select("tweet_id")
    both = rows.join(shared, "tweet_id", "left_semi").distinct()
    least = both.groupBy("tweet_id").agg(F.min("author").alias("a"))
    by_tweet = join_hot(both, least, "tweet_id", F.col("author")).select("a", F.col("author").alias("b"))

    meta = F.col("metadata")
    u = users.where("user_id_hash is not null and metadata is not null").select(F.col("user_id_hash").alias("a"), "metadata")
    names = F.array(*[F.get_json_object(meta, p) for p in ("$.renamed_from", "$.renamed_to", "$.formerly")])
    more = F.coalesce(F.from_json(F.get_json_object(meta, "$.also_posts_as"), "array<string>"), F.array(F.get_json_object(meta, "$.also_posts_as")))
    ops = F.transform(F.array(_operator(meta, "$.operator"), _operator(meta, "$.team.operator")), lambda x: F.concat(F.lit("op:"), x))
    by_user = u.select("a", F.explode(F.concat(names, more, ops)).alias("b")).where("b is not null and b <> ''")
    return by_tweet.unionByName(by_user)


def author_groups(tweets: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``author_id_hash, group_key``) for every tied author that occurs in ``tweets``, and the forest."""
    labels, forest = components(author_edges(tweets, users))
    present = tweets.select(F.col("author_id_hash").alias("node")).where("node is not null").distinct()
    tied = labels.join(present, "node", "left_semi")
    keys = tied.groupBy("root").agg(F.min("node").alias("group_key"), F.count("*").alias("members"))
    return join_hot(tied, keys, "root", F.col("node")).select(F.col("node").alias("author_id_hash"), "group_key", "members"), forest


def deal(groups: DataFrame, proportions: dict[str, float]) -> DataFrame:
    """``g, split`` for the groups ``g, n`` (n records each); the proportions need not sum to 1.

    Only the groups above ``LARGE_SHARE`` (at most 1000 rows) are ranked in the driver; the running
    totals of the others are built in two steps, inside hash buckets and over bucket totals.
    """
    spark, names = groups.sparkSession, list(proportions)
    sums = groups.agg(F.sum("n").alias("n"), F.count("*").alias("groups")).first()
    total, buckets = sums["n"] or 0, 256 + sums["groups"] // BUCKET_GROUPS
    whole = sum(proportions.values())
    room = {s: total * p / whole for s, p in proportions.items()}
    large = groups.where(F.col("n") > total * LARGE_SHARE).orderBy(F.col("n").desc(), "g").collect()  # at most 1 / LARGE_SHARE rows
    placed = []
    for row in large:
        best = max(names, key=lambda s: (room[s], -names.index(s)))
        room[best] -= row["n"]
        placed.append((row["g"], best))
    first = spark.createDataFrame(placed, f"g {dict(groups.dtypes)['g']}, split string")
    left = {s: max(0.0, r) for s, r in room.items()}
    all_left = sum(left.values()) or 1.0
    small = (
        groups.where(F.col("n") <= total * LARGE_SHARE)
        .withColumn("band", F.floor(F.log2(F.greatest(F.col("n"), F.lit(1)))))
        .withColumn("h", F.xxhash64("g"))
        .withColumn("bucket", F.pmod(F.shiftright("h", 3), F.lit(buckets)))
    )
    sums = small.groupBy("band", "bucket").agg(F.sum("n").alias("t"))  # at most one row per 64 bands and bucket
    w = Window.partitionBy("band").orderBy("bucket")
    sums = sums.select("band", "bucket", (F.sum("t").over(w) - F.col("t")).alias("base"), F.sum("t").over(Window.partitionBy("band")).alias("band_total"))
    inside = Window.partitionBy("band", "bucket").orderBy("h", "g")
    middle = (F.col("base") + F.sum("n").over(inside) - F.col("n") / 2) / F.col("band_total")
    chosen, upto = None, 0.0
    for s in names:
        upto += left[s] / all_left
        chosen = F.when(F.col("at") <= upto + 1e-12, s) if chosen is None else chosen.when(F.col("at") <= upto + 1e-12, s)
    dealt = small.join(sums, ["band", "bucket"]).withColumn("at", middle).select("g", chosen.otherwise(names[0]).alias("split"))
    return first.unionByName(dealt)


def split_together(tweets: DataFrame, users: DataFrame, proportions: dict[str, float] | None = None, forest_path: str | None = None) -> DataFrame:
    """``tweet_id, split, group_key``, one row per tweet_id; related tweets share a split.

    The spanning forest (``a, b``: the ties that hold the groups together) is written to
    ``forest_path`` as Parquet, where one is given; it tells why two authors share a split.

    A tweet of an untied author forms a group with that author's other tweets; tweets without any
    author are groups of their own. Rows without tweet_id are dropped; repeated rows count once.
    """
    groups, forest = author_groups(tweets, users)
    if forest_path:
        forest.write.mode("overwrite").parquet(forest_path)
    # every author of one tweet_id is in one group, so any of them serves
    one = tweets.where("tweet_id is not null").groupBy("tweet_id").agg(F.min("author_id_hash").alias("author_id_hash"))
    keyed = join_hot(one, groups.select("author_id_hash", "group_key"), "author_id_hash", F.col("tweet_id"), "left").select(
        "tweet_id", F.coalesce("group_key", "author_id_hash", F.concat(F.lit("tweet:"), "tweet_id")).alias("g")
    )
    sizes = keyed.groupBy("g").agg(F.count("*").alias("n"))
    assigned = deal(sizes, proportions or {"train": 0.8, "validation": 0.1, "test": 0.1})
    return join_hot(keyed, assigned, "g", F.col("tweet_id")).select("tweet_id", "split", F.col("g").alias("group_key"))
