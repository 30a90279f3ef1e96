"""Joins with keys that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key above which it is spread over ``SALTS`` parts.
HOT_ROWS = 200_000
#: At most so many keys are spread: a key must also hold more than this part of all rows.
HOT_KEYS = 100_000
SALTS = 64


def join_hot(many: DataFrame, one: DataFrame, on: str, spread_by: Column, how: str = "inner", rows: int | None = None) -> DataFrame:
    """``many`` joined to ``one`` on ``on``, where ``one`` has at most one row per key.

    Keys with more than ``HOT_ROWS`` rows in ``many`` and more than 1 / HOT_KEYS of its rows (so the
    broadcast list has at most HOT_KEYS keys; counted with map-side combine) are salted: their rows go to ``SALTS`` parts by the hash of ``spread_by``, and
    their single row of ``one`` is repeated that often. All other keys keep one part. ``how`` is
    ``inner`` or ``left``; a null key matches nothing. ``rows``: the number of rows of ``many`` where it
    is known; up to HOT_ROWS of them no key is hot and the join is a plain one.
    """
    if rows is not None and rows <= HOT_ROWS:
        return many.join(one, on, how)
    counts = many.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))  # one row
    hot = counts.join(F.broadcast(total)).where((F.col("_n") > HOT_ROWS) & (F.col("_n") * HOT_KEYS > F.col("_all"))).select(F.col(on).alias("_key"))
    salt = F.when(F.col("_key").isNotNull(), F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    left = many.join(F.broadcast(hot), F.col(on) == F.col("_key"), "left").withColumn("_salt", salt).drop("_key")
    parts = F.when(F.col("_key").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(F.broadcast(hot), F.col(on) == F.col("_key"), "left").withColumn("_salt", F.explode(parts)).drop("_key")
    return left.join(right, [on, "_salt"], how).drop("_salt")
