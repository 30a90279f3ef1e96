"""The batch operators over streams: cleaning, deduplication within a watermark, counts and user counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agorasift.operators.clean import DEFAULT, CleanConfig, clean


def deduplicated(stream: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """The first delivery of each key; keys are remembered for ``late`` behind the watermark."""
    return stream.where(F.col(key).isNotNull()).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def cleaned(stream: DataFrame, text: str = "text", cfg: CleanConfig = DEFAULT) -> DataFrame:
    return clean(stream, text, cfg)


def counts(stream: DataFrame, ts: str, width: str = "1 day", late: str = "1 day", slide: str | None = None) -> DataFrame:
    """``start, end, n`` per window; complete once the watermark has passed."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(w.alias("w")).agg(F.count("*").alias("n")).select("w.start", "w.end", "n")


def users(stream: DataFrame, user: str, ts: str) -> DataFrame:
    """Running counters per user, for update mode; the state is one row per user."""
    return stream.where(F.col(user).isNotNull()).groupBy(F.col(user).alias("user_id_hash")).agg(F.count("*").alias("tweet_count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def append_to(stream: DataFrame, path: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Write all that is there to Parquet and stop; a restart goes on from the checkpoint."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return w.options(**options).start()
