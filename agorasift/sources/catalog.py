"""Catalogue of collections, checkpoints, queries and users as change logs.

Every mutation appends an event; the state is the latest event per key. Reading the state is one
aggregate with map-side combine. Metadata is JSON text, merged shallowly, new values winning.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorasift.functions.joins import join_hot

#: One change: ``put`` replaces the record, ``patch`` sets some of its fields, ``delete`` removes it.
EVENTS = "seq long, kind string, table string, key string, fields map<string,string>, at timestamp"
#: Version of the layout of the log.
VERSION = 1


def latest(events: DataFrame, key: str, order: list[str], deleted: str | None = None) -> DataFrame:
    """The newest event per ``key`` (ties in the order of ``order``); tombstones remove the key."""
    names = [c for c in events.columns if c != key]
    rows = events.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_r")).select(key, "_r.*")
    return rows.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else rows


def merged_metadata(events: DataFrame, key: str, order: list[str], metadata: str = "metadata") -> DataFrame:
    """``key, metadata``: shallow merge of the JSON objects of all events, later fields winning."""
    fields = events.select(key, F.explode(F.from_json(metadata, "map<string,string>")).alias("k", "v"), F.struct(*order).alias("_o"))
    last = fields.groupBy(key, "k").agg(F.max_by("v", "_o").alias("v"))
    return last.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))).alias(metadata))


def listed(collections: DataFrame, status: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of collections, newest first, ties by the larger id."""
    rows = collections.where(F.col("status") == status) if status else collections
    return rows.orderBy(F.desc("created_at"), F.desc("id")).offset(offset).limit(limit)


def history(log: DataFrame, query: str | None = None, limit: int = 100) -> DataFrame:
    rows = log.where(F.col("query") == query) if query else log
    return rows.orderBy(F.desc("executed_at"), F.desc("id")).limit(limit)


def lookup(rows: DataFrame, column: str, value: object) -> DataFrame:
    """The row with ``column = value`` (of several the least id)."""
    return rows.where(F.col(column) == value).orderBy("id").limit(1)


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows whose key was not deleted, for cascades over dependent tables."""
    return rows.join(gone.select(key).distinct(), key, "left_anti")


def user_counters(sightings: DataFrame, user: str, ts: str, metadata: str | None = None) -> DataFrame:
    """``user_id_hash, tweet_count, first_seen, last_seen`` (and the metadata of the first sighting)."""
    aggs = [F.count("*").alias("tweet_count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")]
    if metadata:
        aggs.append(F.min_by(metadata, F.col(ts)).alias("metadata"))
    return sightings.where(F.col(user).isNotNull()).groupBy(F.col(user).alias("user_id_hash")).agg(*aggs)


def user_stats(users: DataFrame) -> DataFrame:
    return users.agg(F.count("*").alias("users"), F.coalesce(F.sum("tweet_count"), F.lit(0)).alias("tweets"), F.round(F.avg("tweet_count"), 2).alias("avg_tweets"))


def state(events: DataFrame, table: str) -> DataFrame:
    """``key, fields, created_at, updated_at`` of every record of ``table`` after all ``events``.

    Every field has its latest value since the record was last put; a record whose latest put or
    delete is a delete, or which was only patched, is not there. Fields named ``metadata.x`` merge one
    by one. Two aggregates with map-side combine, however many events a key has.
    """
    mine = events.where((F.col("table") == table) & F.col("key").isNotNull())
    last = mine.groupBy("key").agg(
        F.max(F.when(F.col("kind") != "patch", F.struct("seq", "kind", "at"))).alias("_begin"), F.min(F.when(F.col("kind") == "put", F.col("at"))).alias("created_at"), F.max("at").alias("updated_at"),
    ).where("_begin.kind = 'put'")
    fields = mine.where("kind <> 'delete'").select("key", "seq", F.explode("fields").alias("f", "v")).join(last.select("key", F.col("_begin.seq").alias("_from")), "key").where("seq >= _from")
    values = fields.groupBy("key", "f").agg(F.max_by("v", "seq").alias("v"))
    maps = values.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("f", "v")))).alias("fields"))
    return last.join(maps, "key", "left").select("key", F.coalesce("fields", F.create_map().cast("map<string,string>")).alias("fields"), "created_at", "updated_at")


class Catalog:
    """Collections, checkpoints, users and the query log in one folder of change events.

    Every call appends one Parquet write, which appears whole or not at all: that is the transaction,
    also for a cascade. One writer at a time; any number of readers. State is read by :func:`state`.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        rows = self.events().where("table = 'schema'").agg(F.max(F.col("fields")["version"].cast("int"))).first()[0]
        if rows is None:
            self._commit([("put", "schema", "version", {"version": VERSION})])
        elif rows > VERSION:
            raise ValueError(f"the catalogue has layout {rows}, this program knows {VERSION}")

    def events(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(self.path)

    def _next(self) -> int:
        return (self.events().agg(F.max("seq")).first()[0] or 0) + 1

    def _commit(self, changes: list[tuple[str, str, str, dict]], at: dt.datetime | None = None) -> int:
        seq, at = self._next(), at or dt.datetime.now(dt.timezone.utc)
        rows = [(seq + i, kind, table, key, {k: None if v is None else str(v) for k, v in fields.items()}, at) for i, (kind, table, key, fields) in enumerate(changes)]
        self.spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(self.path)
        return seq

    @staticmethod
    def _meta(metadata: dict | None) -> dict:
        return {f"metadata.{k}": json.dumps(v) for k, v in (metadata or {}).items()}

    def _has(self, table: str, key: str) -> bool:
        return not state(self.events().where(F.col("key") == key), table).isEmpty()

    def create_collection(self, name: str, query: str, start: object = None, end: object = None, metadata: dict | None = None) -> int:
        """The new collection's id; it starts as ``pending`` with no tweets."""
        new = self._next()
        self._commit([("put", "collections", str(new), {"name": name, "query": query, "start_date": start, "end_date": end, "status": "pending", "tweet_count": 0, **self._meta(metadata)})])
        return new

    def update_collection(self, id_: int, tweet_count: int | None = None, status: str | None = None, metadata: dict | None = None) -> bool:
        fields = {k: v for k, v in (("tweet_count", tweet_count), ("status", status)) if v is not None} | self._meta(metadata)
        if not fields or not self._has("collections", str(id_)):
            return False
        self._commit([("patch", "collections", str(id_), fields)])
        return True

    def delete_collection(self, id_: int) -> bool:
        """Removes the collection and its checkpoint in one commit."""
        if not self._has("collections", str(id_)):
            return False
        self._commit([("delete", "checkpoints", str(id_), {}), ("delete", "collections", str(id_), {})])
        return True

    def save_checkpoint(self, collection: int, last_tweet_id: str | None = None, next_token: str | None = None, items: int = 0, metadata: dict | None = None) -> None:
        self._commit([("put", "checkpoints", str(collection), {"last_tweet_id": last_tweet_id, "next_token": next_token, "items_collected": items, **self._meta(metadata)})])

    def delete_checkpoint(self, collection: int) -> bool:
        had = self._has("checkpoints", str(collection))
        if had:
            self._commit([("delete", "checkpoints", str(collection), {})])
        return had

    def log_query(self, query: str, endpoint: str, count: int | None = None, success: bool = True, error: str | None = None) -> int:
        new = self._next()
        self._commit([("put", "queries", str(new), {"query": query, "endpoint": endpoint, "response_count": count, "success": str(success).lower(), "error_message": error})])
        return new

    def track_user(self, user_hash: str, metadata: dict | None = None) -> None:
        """One more sighting; counts and times follow from the sightings."""
        self._commit([("put", "sightings", f"{user_hash}:{self._next()}", {"user": user_hash, **self._meta(metadata)})])

    def users(self) -> DataFrame:
        seen = state(self.events(), "sightings").select(F.col("fields")["user"].alias("user"), "created_at")
        return user_counters(seen, "user", "created_at")

    def stats(self) -> DataFrame:
        c = state(self.events(), "collections").select(F.col("fields")["status"].alias("status"), F.col("fields")["tweet_count"].cast("long").alias("tweet_count"))
        return catalog_stats(c, self.users(), state(self.events(), "queries"))


def catalog_stats(collections: DataFrame, users: DataFrame, log: DataFrame) -> DataFrame:
    """One row of the five totals."""
    a = collections.agg(F.count("*").alias("collections"), F.count_if(F.col("status") == "completed").alias("completed"), F.coalesce(F.sum("tweet_count"), F.lit(0)).alias("collected"))
    b, c = users.agg(F.count("*").alias("users")), log.agg(F.count("*").alias("queries"))
    return a.join(F.broadcast(b)).join(F.broadcast(c))  # one row each


def counts_per(rows: DataFrame, unit: str, ts: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``start``, the columns ``by`` and ``n``: rows per minute, hour or day of ``ts``; rows without a time do not count."""
    if unit not in ("minute", "hour", "day"):
        raise ValueError(f"unknown unit: {unit}")
    return rows.where(F.col(ts).isNotNull()).groupBy(F.date_trunc(unit, ts).alias("start"), *by).agg(F.count("*").alias("n"))


def with_user(tweets: DataFrame, users: DataFrame, columns: tuple[str, ...] = ("tweet_count",)) -> DataFrame:
    """``tweets`` with columns of their author's record; without a record they are null. One author may have a third of the rows."""
    one = users.where("user_id_hash is not null").select(F.col("user_id_hash").alias("author_id_hash"), *columns)
    return join_hot(tweets, one, "author_id_hash", F.struct("tweet_id", "collected_at"), "left")


def collected(collections: DataFrame, tweets: DataFrame) -> DataFrame:
    """``id, tweet_count, tweets``: the count that a collection states, and the different tweets it has."""
    n = tweets.groupBy(F.col("collection_query").alias("query")).agg(F.count_distinct("tweet_id").alias("tweets"))
    return collections.select("id", "query", "tweet_count").join(n, "query", "left").select("id", "tweet_count", F.coalesce("tweets", F.lit(0)).alias("tweets"))


def numbered(rows: DataFrame, order: list[str], start: int = 1) -> DataFrame:
    """Consecutive ids for a small batch of new catalogue rows."""
    return rows.withColumn("id", (F.row_number().over(Window.orderBy(*order)) + start - 1).cast("long"))


def decoded(rows: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Metadata as a map; text that is no JSON object gives null and stays as it is."""
    return rows.withColumn(f"{metadata}_map", F.from_json(metadata, "map<string,string>", {"mode": "PERMISSIVE"}))
