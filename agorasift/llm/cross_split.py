"""Same or near-same records across splits (problem 4).

Every text gets a 64-bit similarity hash and, as code blocks, the similarity hashes of its
segments. Blocks that both sides have are joined; a pair stays if its whole codes lie within the
Hamming radius, or half of the blocks of the shorter text agree (a copy that was cut off), if its
numbers can be the same, and if its word sketches allow as many common words as the comparison asks
for. Only then the texts are compared. Exact copies (equal core words) are one class and never paired
with each other.

Common phrases give blocks that many texts share, and pairs as the square of the texts. They end in
the join: only pairs that pass all tests of a pair are stored.

The hot case, one message in a great part of all rows, costs one block row per map task and code.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorasift.functions.joins import join_hot
from agorasift.llm import messages as M
from agorasift.session import cut, release

#: Bits in which two 64-bit codes may differ.
RADIUS = 16
_CODED = T.StructType().add("id", "string").add("held", "boolean").add("cls", "binary").add("code", "long").add("mask", "integer").add("blocks", T.ArrayType(T.LongType())).add("size", "short")
for _s in range(M.SKETCH // 64):
    _CODED = _CODED.add(f"s{_s}", "long")


def _code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set = set()  # digests of this partition's classes
    for pdf in batches:
        plain = [M.bare(t) for t in pdf["text"]]
        words = [M.WORD.findall(t.casefold()) for t in plain]
        cls = [xxhash.xxh3_128_digest("\0".join(w)) for w in words]
        code, blocks = M.codes(words)
        out, sets = [], []
        for held, c, b, t, w in zip(pdf["held"], cls, blocks, plain, words):
            new = (c, held) not in seen
            seen.add((c, held))
            out.append([x & 0xFFFFFFFFFF for x in b] if new else [])
            sets.append(() if not new else set(w) if t.isascii() else {x.casefold() for x in M.WORD.findall(t)})
        mask = pd.Series([M.number_mask(t) for t in plain], dtype="int64").astype("uint32").astype("int32")
        yield pd.DataFrame({"id": pdf["id"], "held": pdf["held"], "cls": cls, "code": code, "mask": mask, "blocks": out, "size": pd.Series([len(x) for x in sets], dtype="int16")} | {f"s{i}": x for i, x in enumerate(M.sketches(sets))})


_core = lru_cache(maxsize=20_000)(M.core)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = [M.same_message(*_pair(a, b)) > 0 for a, b in zip(pdf["text_a"], pdf["text_b"])]
        yield pdf.loc[keep, ["cls_a", "cls_b"]]


def _pair(a: str, b: str) -> tuple:
    (x, cx), (y, cy) = _core(a), _core(b)
    return x, y, cx, cy


def linked(tweets: DataFrame, splits: DataFrame, *, held_out: tuple[str, ...] = ("validation", "test"), train: str = "train") -> tuple[DataFrame, DataFrame]:
    """(members ``id, held, cls``, one row per tweet and side; links ``cls_a, cls_b`` of a held-out and a training class).

    ``cls`` stands for the core words of a text; texts without a word are in no class. A tweet counts
    under every side it is assigned to; unassigned tweets, other splits, null ids and null texts take no part.
    """
    sides = splits.where(F.col("split").isin(train, *held_out) & F.col("tweet_id").isNotNull()).select(F.col("tweet_id").alias("id"), (F.col("split") != train).alias("held"))
    sides = sides.groupBy("id").agg(F.min("held").alias("_least"), F.max("held").alias("_most"))  # parted by id, as the join needs it
    sides = sides.select("id", F.explode(F.array_distinct(F.array("_least", "_most"))).alias("held"))
    texts = tweets.where("tweet_id is not null and text_raw is not null").select(F.col("tweet_id").alias("id"), F.col("text_raw").alias("text"))
    one = texts.dropDuplicates(["id"])
    coded = one.join(sides, "id").select("id", "held", "text").mapInPandas(_code, _CODED)
    coded = cut(coded.withColumn("no", F.monotonically_increasing_id()))  # numbers stay as they are once stored
    release(tweets.sparkSession)
    empty = xxhash.xxh3_128_digest("")
    coded = coded.where(F.col("cls") != F.lit(bytearray(empty)))

    # numbers of a task's texts lie close together, so these rows pack well; what a pair is tested by follows for shared blocks only
    sketch = [f"s{i}" for i in range(M.SKETCH // 64)]
    told = coded.where(F.size("blocks") > 0).select("no", "code", "mask", F.size("blocks").cast("short").alias("n"), "size", *sketch)
    blocks = coded.where(F.size("blocks") > 0).select(F.explode("blocks").alias("block"), "held", "no").repartition("block")
    ours, theirs = blocks.where("held"), blocks.where("not held")
    shared = ours.join(theirs, "block", "left_semi").unionByName(theirs.join(ours, "block", "left_semi"))
    shared = shared.join(told, "no").drop("no").repartition("block")

    def side(held: bool, s: str) -> DataFrame:
        of = shared.where(F.col("held") == held).drop("held").distinct()
        return of.select("block", *(F.col(c).alias(c + s) for c in of.columns if c != "block"))

    both = F.col("maska").bitwiseAND(F.col("maskb"))
    missing = lambda a, b: sum((F.bit_count(F.col(x + a).bitwiseAND(F.bitwise_not(F.col(x + b)))) for x in sketch), F.lit(0))
    common = F.least(F.col("sizea") - missing("a", "b"), F.col("sizeb") - missing("b", "a"))  # at most
    near = side(True, "a").join(side(False, "b"), "block").where((both == F.col("maska")) | (both == F.col("maskb"))).where(common >= M.SHARED * F.least("sizea", "sizeb") - 1e-6)
    near = near.select(F.col("codea").alias("ca"), F.col("codeb").alias("cb"), F.col("na"), F.col("nb"), F.col("maska").alias("ma"), F.col("maskb").alias("mb"))
    near = near.groupBy("ca", "cb", "na", "nb", "ma", "mb").agg(F.count("*").alias("same"))
    within = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= RADIUS
    near = cut(near.where(within | (F.col("same") * 2 >= F.least("na", "nb"))).select("ca", "cb").distinct())
    release(tweets.sparkSession)

    def sample(held: bool, s: str) -> DataFrame:
        """Classes of one side that have a candidate code, with one text each."""
        wanted = near.select(F.col(f"c{s}").alias("code")).distinct()
        reps = coded.where(F.col("held") == held).join(wanted, "code", "left_semi").groupBy("cls", "code").agg(F.min("id").alias("id"))
        return reps.join(one, "id").select(F.col("code").alias(f"c{s}"), F.col("cls").alias(f"cls_{s}"), F.col("text").alias(f"text_{s}"))

    cand = near.join(sample(True, "a"), "ca").join(sample(False, "b"), "cb").where("cls_a <> cls_b").select("cls_a", "cls_b", "text_a", "text_b")
    return coded.select("id", "held", "cls"), cut(cand.mapInPandas(_verify, "cls_a binary, cls_b binary").distinct())


def overlaps(tweets: DataFrame, splits: DataFrame, *, held_out: tuple[str, ...] = ("validation", "test"), train: str = "train") -> DataFrame:
    """Distinct ``held_id, train_id``: a held-out tweet and a training tweet that are copies of one message.

    Sides as in :func:`linked`. Empty tables give an empty result.
    """
    coded, links = linked(tweets, splits, held_out=held_out, train=train)
    held, kept = coded.where("held").select("id", "cls"), coded.where("not held").select("id", "cls")
    same = held.select(F.col("id").alias("held_id"), "cls").join(kept.select(F.col("id").alias("train_id"), "cls"), "cls").select("held_id", "train_id")
    other = (
        links.join(held.select(F.col("id").alias("held_id"), F.col("cls").alias("cls_a")), "cls_a")
        .join(kept.select(F.col("id").alias("train_id"), F.col("cls").alias("cls_b")), "cls_b")
        .select("held_id", "train_id")
    )
    return same.unionByName(other).where("held_id <> train_id").distinct()


def found(tweets: DataFrame, splits: DataFrame) -> DataFrame:
    """``tweet_id_a, tweet_id_b``, the smaller id first."""
    return overlaps(tweets, splits).select(F.least("held_id", "train_id").alias("tweet_id_a"), F.greatest("held_id", "train_id").alias("tweet_id_b")).distinct()


def classes(tweets: DataFrame, splits: DataFrame) -> DataFrame:
    """``tweet_id, held, cls, links``: every assigned tweet with its class, and how many classes of the other side it is linked to.

    Tweets of equal core words share the class; no pair of copies is written out.
    """
    members, links = linked(tweets, splits)
    per = links.select(F.lit(True).alias("held"), F.col("cls_a").alias("cls")).unionByName(links.select(F.lit(False).alias("held"), F.col("cls_b").alias("cls")))
    per = per.groupBy(F.concat(F.hex("cls"), F.col("held").cast("string")).alias("key")).agg(F.count("*").alias("links"))
    keyed = members.withColumn("key", F.concat(F.hex("cls"), F.col("held").cast("string")))
    return join_hot(keyed, per, "key", F.col("id"), "left").select(F.col("id").alias("tweet_id"), "held", F.hex("cls").alias("cls"), F.coalesce("links", F.lit(0)).alias("links"))


def report(tweets: DataFrame, splits: DataFrame) -> DataFrame:
    """``split, collection_query, tweets, leaked, pairs`` per held-out split and source.

    ``tweets``: distinct assigned tweets of that source; ``leaked``: those with a copy in training;
    ``pairs``: how many pairs they form. Counted from class sizes and links between classes; no pair is formed.
    """
    members, links = linked(tweets, splits)
    kept = members.where("not held").groupBy("cls").agg(F.count("*").alias("n"))
    met = links.join(kept.select(F.col("cls").alias("cls_b"), "n"), "cls_b").select(F.col("cls_a").alias("cls"), "n")
    per = kept.select("cls", "n").unionByName(met).groupBy("cls").agg(F.sum("n").alias("pairs"))
    mine = members.where("held").select("id", "cls").join(members.where("not held").select("id", F.lit(1).alias("own")), "id", "left")  # a tweet is no copy of itself
    pairs = join_hot(mine, per, "cls", F.col("id")).select(F.col("id").alias("tweet_id"), (F.col("pairs") - F.coalesce("own", F.lit(0))).alias("pairs")).where("pairs > 0")
    held = splits.where("split in ('validation', 'test')").select("tweet_id", "split").distinct()
    sources = tweets.select("tweet_id", "collection_query").distinct().join(held, "tweet_id")
    rows = sources.join(pairs, "tweet_id", "left")
    return rows.groupBy("split", "collection_query").agg(F.count("*").alias("tweets"), F.count("pairs").alias("leaked"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
