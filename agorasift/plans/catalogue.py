"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorasift.plans import records, texts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return texts.QUERIES | records.QUERIES


def oracle_sql() -> dict[str, str]:
    return texts.ORACLES | records.ORACLES


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty tweets with the highest keyword score: scan, automaton, score expression, top-k."""
    rows = texts.keyword_score(spark, folder)
    return rows.orderBy(F.desc("total_score"), "tweet_id", "collected_at").limit(20)
