"""Pairs inside groups of equal keys, built from distinct forms so that equal forms are never paired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorasift.session import cut


def pairs_of_forms(members: DataFrame, key: str, form: str, member: str) -> DataFrame:
    """Distinct (``member_a, member_b``), a < b, of one ``key`` whose ``form`` differs.

    Forms are paired first, one row per (key, form); only pairs of different forms are then
    expanded to members, so the work follows the rows of the result and not the group's square.
    """
    m = cut(members.select(F.col(key).alias("k"), F.col(form).alias("f"), F.col(member).alias("m")).distinct())
    forms = m.select("k", "f").distinct()
    pairs = forms.select("k", F.col("f").alias("fa")).join(forms.select("k", F.col("f").alias("fb")), "k").where("fa < fb")
    left = m.select("k", F.col("f").alias("fa"), F.col("m").alias("x"))
    right = m.select("k", F.col("f").alias("fb"), F.col("m").alias("y"))
    out = pairs.join(left, ["k", "fa"]).join(right, ["k", "fb"]).where("x <> y")
    return out.select(F.least("x", "y").alias(f"{member}_a"), F.greatest("x", "y").alias(f"{member}_b")).distinct()
