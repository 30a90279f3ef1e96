"""Capping the records of dominant contributors (problem 6).

Each contributor may keep at most ``cap`` records. The cap is apportioned over the contributor's
strata (topics, periods, ...): slots go to the strata in proportion to their weight, whole slots
first, the rest by largest remainder; a stratum smaller than its share passes its spare slots on to
the others. Inside a stratum the records of best quality stay.

Only the ranked candidates meet in one place: the records are first ranked inside
(contributor, stratum, salt), where at most ``cap`` of each salt can still be kept, so the second
ranking sees at most ``cap * SALTS`` rows of a contributor's stratum, however dominant it is. A
share alone has no such bound; ranks are then taken inside ranges of the order and summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorasift.functions.ranks import ranked

#: Parts into which a contributor's stratum is cut for the first ranking.
SALTS = 64


def latest_rows(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """One row per ``key``: that of the greatest ``order`` (a null order ranks lowest).

    The aggregate combines on the map side, so a key delivered very often costs no more than others.
    """
    picked = F.max_by(F.struct(*columns), F.coalesce(F.col(order), F.lit("0001-01-01").cast("timestamp")))
    return df.groupBy(key).agg(picked.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])


def _valid(quality: Column) -> Column:
    return quality.isNotNull() & ~F.isnan(quality)


def apportion(strata: DataFrame, cap: Column, weighting: str = "proportional") -> DataFrame:
    """Slots per (contributor, stratum) from the columns ``c, s, n``; adds the column ``slots``.

    Strata fill from the smallest need per weight on; while a stratum needs no more than its share
    of what is left it gets all it needs. From the first that needs more on, the rest is dealt in
    proportion, by largest remainder (ties: the stratum that sorts first, nulls first).
    """
    weight = F.col("n").cast("double") if weighting == "proportional" else F.lit(1.0)
    t = strata.withColumn("w", weight).withColumn("cap", cap.cast("long"))
    need = Window.partitionBy("c").orderBy(F.col("n") / F.col("w"), F.col("s").asc_nulls_first())
    before, from_here = need.rowsBetween(Window.unboundedPreceding, -1), need.rowsBetween(0, Window.unboundedFollowing)
    t = (
        t.withColumn("left", F.col("cap") - F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(from_here))
        .withColumn("fits", F.col("n") * F.col("w_left") <= F.col("left") * F.col("w"))
        .withColumn("full", F.min(F.col("fits").cast("int")).over(need.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    )
    rest = Window.partitionBy("c", "full")
    t = (
        t.withColumn("share", F.max("left").over(rest) * F.col("w") / F.sum("w").over(rest))
        .withColumn("whole", F.floor(F.col("share") + 1e-9))
        .withColumn("over", F.max("left").over(rest) - F.sum("whole").over(rest))
        .withColumn(
            "turn",
            F.row_number().over(rest.orderBy((F.col("share") - F.col("whole")).desc(), F.col("s").asc_nulls_first())),
        )
    )
    slots = F.when(F.col("full"), F.col("n")).otherwise(F.col("whole") + (F.col("turn") <= F.col("over")).cast("int"))
    return t.select("c", "s", "n", slots.cast("long").alias("slots"))


def cap_contributors(
    df: DataFrame,
    *,
    id_col: str,
    contributor: str,
    quality: str,
    cap: int | None = None,
    max_share: float | None = None,
    strata: Column | None = None,
    weighting: str = "proportional",
) -> DataFrame:
    """The records that stay: ``id_col, contributor, quality, stratum, place``, one row per record.

    ``df`` holds one row per ``id_col``. ``cap`` is a count, ``max_share`` a share of all records
    (the smaller bound holds, at least 1). Without ``strata`` a contributor has one stratum, which
    gets the whole cap. Quality ranks downwards, null and NaN lowest, ties by the smaller id.
    Records without a contributor (null) belong to nobody and all stay, with place null; records
    without id are dropped. An empty input gives an empty result; extra columns are not read.
    """
    if cap is None and max_share is None:
        raise ValueError("cap or max_share is needed")
    one = strata if strata is not None else F.lit("all")
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(contributor).alias("c"), F.col(quality).cast("double").alias("q"), one.cast("string").alias("s")
    )
    owned = rows.where(F.col("c").isNotNull())
    bound = F.lit(cap) if cap is not None else F.lit(2**62)
    counts = owned.groupBy("c", "s").agg(F.count("*").alias("n"))
    if max_share is not None:
        total = rows.agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(max_share))).alias("by_share"))
        counts = counts.join(F.broadcast(total))  # one row
        bound = F.least(bound, F.col("by_share"))
    slots = apportion(counts, bound, weighting)
    best = [F.when(_valid(F.col("q")), 1).otherwise(0).desc(), F.when(_valid(F.col("q")), F.col("q")).desc(), F.col("i").asc()]
    if cap is not None:
        first = Window.partitionBy("c", "s", "_salt").orderBy(*best)
        key = (
            owned.withColumn("_salt", F.pmod(F.xxhash64("i"), F.lit(SALTS)))
            .withColumn("_r", F.row_number().over(first))
            .where(F.col("_r") <= cap)
            .drop("_r", "_salt")
        )
        key = key.withColumn("place", F.row_number().over(Window.partitionBy("c", "s").orderBy(*best)))
    else:
        key = ranked(owned, ["c", "s"], best, "place").withColumn("place", F.col("place").cast("int"))
    kept = (
        key.join(slots.select(F.col("c").alias("c2"), F.col("s").alias("s2"), "slots"), (F.col("c") == F.col("c2")) & F.col("s").eqNullSafe(F.col("s2")))
        .where(F.col("place") <= F.col("slots"))
        .select("i", "c", "q", "s", "place")
    )
    free = rows.where(F.col("c").isNull()).select("i", "c", "q", "s", F.lit(None).cast("int").alias("place"))
    return kept.unionByName(free).select(
        F.col("i").alias(id_col), F.col("c").alias(contributor), F.col("q").alias(quality), F.col("s").alias("stratum"), "place"
    )


def dropped(df: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    """The ids of ``df`` that are not among ``kept``; the join key is unique on both sides."""
    return df.select(id_col).where(F.col(id_col).isNotNull()).join(kept.select(id_col), id_col, "left_anti")
