"""Stored tweets: fixed schema, date partitions, filtered reads, validation, statistics and compaction."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stored columns in order.
STORED = (
    "tweet_id string, text_raw string, text_clean string, created_at timestamp, author_id_hash string, political_entities array<string>, political_topics array<string>, "
    "political_score float, collection_query string, collected_at timestamp, lang string, is_reply boolean, is_retweet boolean, is_quote boolean, retweet_count int, "
    "reply_count int, like_count int, hashtags array<string>, mentions array<string>"
)
NAMES = [part.split()[0] for part in STORED.split(", ")]


def normalize(df: DataFrame, query: str, collected_at: Column | None = None, author_hash: Column | None = None) -> DataFrame:
    """Any tweet table in the stored schema: ids coalesced, ISO times parsed (unreadable: null), defaults filled."""
    have = dict(df.dtypes)

    def take(*names: str, default: object = None) -> Column:
        cols = [F.col(n) for n in names if n in have]
        return F.coalesce(*cols, F.lit(default)) if cols else F.lit(default)

    def lists(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast("array<string>")) if name in have else F.array().cast("array<string>")

    created = F.lit(None)
    if "created_at" in have:
        created = F.try_to_timestamp(F.col("created_at")) if have["created_at"] == "string" else F.col("created_at")
    author = take("author_id_hash", default="")
    if author_hash is not None and "author_id" in have:
        author = F.coalesce(author_hash, author)
    values = {
        "tweet_id": take("tweet_id", "id", default="").cast("string"), "text_raw": take("text_raw", "text", default=""), "text_clean": take("text_clean"), "created_at": created, "author_id_hash": author,
        "political_entities": lists("political_entities"), "political_topics": lists("political_topics"), "political_score": take("political_score"), "collection_query": F.lit(query),
        "collected_at": collected_at if collected_at is not None else F.current_timestamp(), "lang": take("lang"), "is_reply": take("is_reply", default=False), "is_retweet": take("is_retweet", default=False),
        "is_quote": take("is_quote", default=False), "retweet_count": take("retweet_count"), "reply_count": take("reply_count"), "like_count": take("like_count"), "hashtags": lists("hashtags"), "mentions": lists("mentions"),
    }
    kinds = dict(part.split(" ", 1) for part in STORED.split(", "))
    return df.select(*[values[n].cast(kinds[n]).alias(n) for n in NAMES])


class TweetStore:
    """A folder of Parquet files, partitioned by year and month of the time of collection."""

    def __init__(self, spark: SparkSession, path: str, compression: str = "snappy", rows_per_file: int = 0) -> None:
        self.spark, self.path, self.compression, self.rows_per_file = spark, path, compression, rows_per_file
        self.recover()

    def recover(self) -> None:
        """Finish a compaction that ended between its two renames: the new folder takes the store's place, or the old one returns."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        here = hadoop(self.path)
        fs = here.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(here):
            return
        for kind in ("new", "old"):
            for found in fs.globStatus(hadoop(f"{self.path}.*.{kind}")) or []:
                if kind == "old" or fs.exists(hadoop(f"{found.getPath()}/_SUCCESS")):  # written whole
                    fs.rename(found.getPath(), here)
                    return

    def append(self, tweets: DataFrame) -> int:
        """Add rows in the stored schema; gives the store's number of rows then. An empty input is an error."""
        if tweets.isEmpty():
            raise ValueError("no tweets to write")
        dated = tweets.withColumn("year", F.date_format("collected_at", "yyyy")).withColumn("month", F.date_format("collected_at", "MM"))
        w = dated.write.mode("append").option("compression", self.compression).partitionBy("year", "month")
        (w.option("maxRecordsPerFile", self.rows_per_file) if self.rows_per_file else w).parquet(self.path)
        return self.read(["tweet_id"]).count()  # from the footers

    def read(self, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
        df = self.spark.read.schema(f"{STORED}, year string, month string").parquet(self.path)
        df = df.where(where) if where is not None else df
        return df.select(*(columns or NAMES))

    def batches(self, columns: list[str] | None = None, size: int = 10_000) -> Iterator[list]:
        """Rows in lists of ``size``, partition by partition, never all at once."""
        batch: list = []
        for row in self.read(columns).toLocalIterator(prefetchPartitions=True):
            batch.append(row)
            if len(batch) == size:
                yield batch
                batch = []
        if batch:
            yield batch

    def query(self, **kw: object) -> DataFrame:
        return query_tweets(self.spark.read.schema(f"{STORED}, year string, month string").parquet(self.path).select(*NAMES), **kw)

    def files(self) -> list[str]:
        return sorted(self.spark.read.parquet(self.path).inputFiles())

    def stats(self) -> DataFrame:
        """One row: files, bytes, megabytes (2 digits), rows."""
        rows = self.spark.read.parquet(self.path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
        per = rows.groupBy("f").agg(F.max("b").alias("b"), F.count("*").alias("n"))
        return per.agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.round(F.sum("b") / 1048576, 2).alias("megabytes"), F.sum("n").alias("rows"))

    def validate(self) -> dict:
        """Missing stored columns, rows, files, and of one file its row groups and writer."""
        df = self.spark.read.parquet(self.path)
        missing = [n for n in NAMES if n not in df.columns]
        files = self.files()
        conf, jvm = self.spark._jsc.hadoopConfiguration(), self.spark._jvm
        groups = writer = None
        if files:
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(files[0]), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                groups, writer = reader.getRowGroups().size(), reader.getFileMetaData().getCreatedBy()
            finally:
                reader.close()
        return {"valid": not missing, "missing_fields": missing, "rows": df.count(), "files": len(files), "row_groups": groups, "created_by": writer}

    def delete(self, file: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(file)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, False)

    def compact(self, files_per_month: int = 1) -> int:
        """Rewrite every month into few files beside the store, then swap the folders; gives the number of rows."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        old = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = old.getFileSystem(conf)
        new, away = f"{self.path}.{uuid.uuid4().hex[:8]}.new", f"{self.path}.{uuid.uuid4().hex[:8]}.old"
        df = self.spark.read.schema(f"{STORED}, year string, month string").parquet(self.path)
        spread = df.repartition("year", "month", F.pmod(F.xxhash64("tweet_id"), F.lit(files_per_month)))
        spread.write.option("compression", self.compression).partitionBy("year", "month").parquet(new)
        n = self.spark.read.parquet(new).count()
        fs.rename(old, jvm.org.apache.hadoop.fs.Path(away))
        fs.rename(jvm.org.apache.hadoop.fs.Path(new), old)
        fs.delete(jvm.org.apache.hadoop.fs.Path(away), True)
        return n


def query_tweets(df: DataFrame, query: str | None = None, start: object = None, end: object = None, min_score: float | None = None, lang: str | None = None, limit: int | None = None) -> DataFrame:
    """Conjunction of the filters given (falsy ones are skipped, both ends of the time range belong to it); nulls and NaN never match."""
    conditions = [
        (query, lambda v: F.col("collection_query") == v), (start, lambda v: F.col("created_at") >= F.lit(v)), (end, lambda v: F.col("created_at") <= F.lit(v)),
        (min_score, lambda v: (F.col("political_score") >= v) & ~F.isnan("political_score")), (lang, lambda v: F.col("lang") == v),
    ]
    for value, condition in conditions:
        if value:
            df = df.where(condition(value))
    return df.limit(limit) if limit else df


def read_items(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Items from Parquet, CSV, or JSON as an envelope ``{"metadata", "items"}``, a bare array or lines."""
    if path.endswith((".parquet", "/")):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    raw = spark.read.option("multiLine", not path.endswith(".jsonl"))
    raw = raw.schema(schema).json(path) if schema else raw.json(path)
    if "items" in raw.columns and dict(raw.dtypes)["items"].startswith("array<struct"):
        return raw.select(F.explode("items").alias("_i")).select("_i.*")
    return raw


def write_items(df: DataFrame, path: str, kind: str = "parquet", metadata: dict | None = None) -> None:
    """Items as Parquet (snappy), JSON lines with a side file of metadata, or CSV (nested columns as JSON)."""
    if kind == "parquet":
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    elif kind == "json":
        df.write.mode("overwrite").json(path)
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_metadata.json")
        out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
        out.write(bytearray(json.dumps(metadata or {}, default=str).encode()))
        out.close()
    elif kind == "csv":
        flat_nested(df).write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format: {kind}")


def flat_nested(df: DataFrame, suffix: str = "") -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    return df.select(*[F.to_json(n).alias(n + suffix) if t.startswith(("array", "map", "struct")) else F.col(n) for n, t in df.dtypes])
