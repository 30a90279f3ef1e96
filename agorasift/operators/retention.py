"""Retention periods and deletion requests as data operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days that each kind of data is kept; other kinds are kept as raw data.
DAYS = {"raw": 365, "processed": 730, "metadata": 1095}
REQUEST_DAYS = 30


def expiration(df: DataFrame, created: str, kind: Column, now: Column) -> DataFrame:
    """Adds ``expires_at``, ``expired`` and ``days_remaining`` (whole days, 0 when expired); a null time stays null."""
    days = F.lit(DAYS["raw"])
    for k, d in DAYS.items():
        days = F.when(kind == k, d).otherwise(days)
    out = df.withColumn("expires_at", F.timestamp_add("DAY", days, F.col(created)))
    out = out.withColumn("expired", now > F.col("expires_at"))
    left = F.floor((F.unix_timestamp("expires_at") - F.unix_timestamp(now)) / 86400)
    return out.withColumn("days_remaining", F.when(F.col("expired"), 0).otherwise(left))


def pending(requests: DataFrame, now: Column) -> DataFrame:
    """Open requests (``user, requested_at, completed_at``) with their deadline and whole days left."""
    due = F.timestamp_add("DAY", F.lit(REQUEST_DAYS), F.col("requested_at"))
    left = F.floor((F.unix_timestamp(due) - F.unix_timestamp(now)) / 86400)
    return requests.where("completed_at is null").select("*", due.alias("deadline"), F.greatest(left, F.lit(0)).alias("days_remaining"), (left < 0).alias("overdue"))


def without_deleted(df: DataFrame, key: str, requests: DataFrame, user: str = "user") -> DataFrame:
    """Rows whose key is in no deletion request; rows without a key stay."""
    gone = requests.select(F.col(user).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(gone, key, "left_anti")
