"""Readers of the stored tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``; columns are pruned and filters pushed by Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer partitions than half of them; else ``df`` itself.

    For work in Python or long expressions over a small single file. Large inputs have enough
    partitions and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() * 2 <= cores else df
