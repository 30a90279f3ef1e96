"""Exact ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorasift.session import cut


def ranked(df: DataFrame, group: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """Adds the rank (from 1) of each row inside its group, whatever the group's share of all rows.

    The rows are range-partitioned by group and order, so a hot group spans many partitions; ranks are
    taken inside (group, partition) and raised by the sizes of the group's partitions before. ``order``
    must tell rows apart for a stable result. Null group values form groups of their own.
    """
    parts = cut(df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    base = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_n")
    sizes = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), base.alias("_base"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    condition = F.col("_part") == F.col("_p")
    for c in same:
        condition &= c
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    return parts.withColumn("_in", inside).join(sizes, condition).withColumn(out, F.col("_base") + F.col("_in")).drop("_in", "_part", "_p", "_base", *[f"_g{i}" for i in range(len(group))])
