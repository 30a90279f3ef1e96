"""Queries of annotation, sampling, storage, catalogue, finance, retention and streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorasift import streaming
from agorasift.operators import annotate, retention, sampling
from agorasift.session import checkpoint_dir
from agorasift.sources import catalog, finance, store
from agorasift.sources.tables import table

NOW = "2025-03-01 00:00:00"
LEFT, RIGHT = ["civic alliance", "commons party"], ["harvest union", "northern reform"]


def _latest(s: SparkSession, d: str) -> DataFrame:
    return catalog.latest(table(s, d, "tweets"), "tweet_id", ["collected_at"])


def gold_majority(s: SparkSession, d: str) -> DataFrame:
    x = annotate.majority(table(s, d, "annotations"))
    return x.withColumn("topics", F.array_join("topics", ","))


def gold_weighted(s: SparkSession, d: str) -> DataFrame:
    x = annotate.weighted(table(s, d, "annotations"))
    return x.select("item_id", F.round("political_leaning", 6).alias("political_leaning"), F.round("sentiment", 6).alias("sentiment"), "is_political", "annotation_count")


def gold_average(s: SparkSession, d: str) -> DataFrame:
    x = annotate.average(table(s, d, "annotations"))
    return x.select("item_id", F.round("political_leaning", 6).alias("political_leaning"), F.round("sentiment", 6).alias("sentiment"), "annotation_count")


def agreement(s: SparkSession, d: str) -> DataFrame:
    return annotate.agreement(table(s, d, "annotations"))


def annotation_stats(s: SparkSession, d: str) -> DataFrame:
    return annotate.annotation_stats(table(s, d, "annotations"))


def annotations_by_annotator(s: SparkSession, d: str) -> DataFrame:
    return annotate.normalized(table(s, d, "annotations")).where("annotator_id = 'ann-000001'").select("item_id", "seq", "political_leaning", "sentiment")


def class_histogram(s: SparkSession, d: str) -> DataFrame:
    return sampling.class_sizes(table(s, d, "documents"), "doc_type")


def by_class_undersample(s: SparkSession, d: str) -> DataFrame:
    return sampling.by_class(table(s, d, "documents"), "lang", "doc_id", per_class=20).select("doc_id", "class")


def by_class_lists(s: SparkSession, d: str) -> DataFrame:
    """Balanced over a list column: an item counts in each of its topics."""
    return sampling.by_class(_latest(s, d), "political_topics", "tweet_id").select("tweet_id", "class")


def by_class_oversample(s: SparkSession, d: str) -> DataFrame:
    return sampling.by_class(table(s, d, "documents"), "lang", "doc_id", per_class=60, strategy="oversample").select("doc_id", "class", "draw")


def political_labels(s: SparkSession, d: str) -> DataFrame:
    return sampling.political_sides(_latest(s, d), LEFT, RIGHT, "text_raw").groupBy("political_label").agg(F.count("*").alias("n"))


def political_balance(s: SparkSession, d: str) -> DataFrame:
    return sampling.political_balance(_latest(s, d), LEFT, RIGHT, "tweet_id", text="text_raw", neutral=True).select("tweet_id", "political_label")


def split_random(s: SparkSession, d: str) -> DataFrame:
    return sampling.split(table(s, d, "documents"), "doc_id").select("doc_id", "split")


def split_stratified(s: SparkSession, d: str) -> DataFrame:
    return sampling.split(table(s, d, "documents"), "doc_id", (0.7, 0.15, 0.15), stratify="lang").select("doc_id", "split")


def sample_n(s: SparkSession, d: str) -> DataFrame:
    """The sampling operator: fifty documents without replacement."""
    return sampling.sample(table(s, d, "documents"), 50, "doc_id").select("doc_id")


def merge_by_id(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "tweets").select("tweet_id", "text_raw", "collected_at", "author_id_hash")
    old, new = t.where("collected_at < '2024-07-01'"), t.where("collected_at >= '2024-07-01'")
    return sampling.merge([old, new], "tweet_id", order="collected_at").select("tweet_id", "collected_at", "author_id_hash")


def merge_by_content(s: SparkSession, d: str) -> DataFrame:
    """Rows without an id, told apart by their content."""
    a = table(s, d, "documents").select("text", "lang")
    return sampling.merge([a, a.where("lang = 'en'")], "none").select(F.md5("text").alias("text_md5"), "lang")


def merge_input_order(s: SparkSession, d: str) -> DataFrame:
    """English rows first, then all, each in the order of the file."""
    t = table(s, d, "tweets")
    keep = ("tweet_id", "collected_at", "author_id_hash")
    return sampling.merge([t.where("lang = 'en'"), t], "tweet_id").select(*keep)


def store_query(s: SparkSession, d: str) -> DataFrame:
    rows = store.query_tweets(table(s, d, "tweets"), start="2024-03-01", end="2024-09-30", min_score=0.5, lang="en")
    return rows.select("tweet_id", "collected_at", "created_at", F.col("political_score").cast("double").alias("political_score"))


def normalize_tweets(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "tweets").select(F.col("tweet_id").alias("id"), F.col("text_raw").alias("text"), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"), "lang", "like_count", "collected_at", "author_id_hash")
    rows = store.normalize(raw, "all", F.col("collected_at"))
    return rows.select("tweet_id", "collected_at", "created_at", "lang", "is_reply", "like_count", "collection_query", F.size("hashtags").alias("tags"))


def count_by_day(s: SparkSession, d: str) -> DataFrame:
    return catalog.counts_per(table(s, d, "tweets"), "day", "created_at").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


def count_by_hour_events(s: SparkSession, d: str) -> DataFrame:
    return catalog.counts_per(table(s, d, "events"), "hour", "ts", ("event_type",)).withColumnRenamed("start", "hour")


def latest_tweets(s: SparkSession, d: str) -> DataFrame:
    return _latest(s, d).select("tweet_id", "collected_at", "author_id_hash", "like_count")


def user_counters(s: SparkSession, d: str) -> DataFrame:
    return catalog.user_counters(table(s, d, "tweets"), "author_id_hash", "collected_at")


def user_stats(s: SparkSession, d: str) -> DataFrame:
    return catalog.user_stats(table(s, d, "users"))


def catalog_page(s: SparkSession, d: str) -> DataFrame:
    """A page of the catalogue: the second five completed collections, newest first."""
    return catalog.listed(table(s, d, "collections"), "completed", 5, 5).select("id", "name", "created_at")


def catalog_stats(s: SparkSession, d: str) -> DataFrame:
    log = table(s, d, "tweets").select("collection_query", F.date_trunc("day", "collected_at").alias("day")).distinct()  # one query a day
    return catalog.catalog_stats(table(s, d, "collections"), table(s, d, "users"), log)


def _event(seq: str, kind: str, name: str, key: str, *fields: str) -> list:
    pairs = [x for f in fields for x in (F.lit(f), F.col(f).cast("string"))]
    return [F.expr(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), F.lit(name).alias("table"), F.col(key).cast("string").alias("key"), F.create_map(*pairs).alias("fields"), F.lit(NOW).cast("timestamp").alias("at")]


def catalog_changes(s: SparkSession, d: str) -> DataFrame:
    """The catalogue after inserts, updates of status and metadata, and deletions, read from its events."""
    c = table(s, d, "collections")
    new = c.select(*_event("id", "put", "collections", "id", "name", "status", "tweet_count"))
    ended = c.where("end_date is null").withColumn("status", F.lit("open")).withColumn("note", F.lit("no end")).select(*_event("1000 + id", "patch", "collections", "id", "status", "note"))
    gone = c.where("status = 'failed'").select(F.expr("2000 + id").cast("long").alias("seq"), F.lit("delete").alias("kind"), F.lit("collections").alias("table"), F.col("id").cast("string").alias("key"), F.create_map().cast("map<string,string>").alias("fields"), F.lit(NOW).cast("timestamp").alias("at"))
    rows = catalog.state(new.unionByName(ended).unionByName(gone), "collections")
    f = F.col("fields")
    return rows.select(F.col("key").cast("long").alias("id"), f["name"].alias("name"), f["status"].alias("status"), f["tweet_count"].cast("long").alias("tweet_count"), f["note"].alias("note"))


def catalog_lookup(s: SparkSession, d: str) -> DataFrame:
    return catalog.lookup(table(s, d, "collections"), "name", "river_levy_2024").select("id", "name", "query", "status")


def metadata_fields(s: SparkSession, d: str) -> DataFrame:
    fields = catalog.decoded(table(s, d, "users")).select("id", F.explode("metadata_map").alias("field", "value"))
    return fields.groupBy("field").agg(F.count("*").alias("users"))


def tweet_user_lookup(s: SparkSession, d: str) -> DataFrame:
    return catalog.with_user(table(s, d, "tweets").select("tweet_id", "collected_at", "author_id_hash"), table(s, d, "users")).select("tweet_id", "collected_at", "tweet_count")


def collection_counts(s: SparkSession, d: str) -> DataFrame:
    return catalog.collected(table(s, d, "collections"), table(s, d, "tweets"))


def finance_candidates(s: SparkSession, d: str) -> DataFrame:
    return finance.candidates(table(s, d, "candidates"), election_year=2024, office="S").select("candidate_id", "name", "state")


def finance_committees(s: SparkSession, d: str) -> DataFrame:
    return finance.committees(table(s, d, "committees"), q="citizens", types=["N", "H", "S"]).select("committee_id", "name", "committee_type")


def finance_contributions(s: SparkSession, d: str) -> DataFrame:
    x = finance.contributions(table(s, d, "contributions"), committee_id="C40000001", min_amount=25, max_amount=500, period=2024)
    return x.select("contribution_id", "contribution_amount", F.col("receipt_date").cast("string").alias("receipt_date"))


def finance_by_name(s: SparkSession, d: str) -> DataFrame:
    """The hundred newest contributions of a name, as the search returns them."""
    return finance.contributions(table(s, d, "contributions"), name="conduit", limit=100).select("contribution_id", F.col("receipt_date").cast("string").alias("receipt_date"))


def finance_totals(s: SparkSession, d: str) -> DataFrame:
    return finance.candidate_totals(table(s, d, "contributions"))


def retention_expired(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("text_clean").isNotNull(), "processed").otherwise("raw")
    x = retention.expiration(table(s, d, "tweets"), "collected_at", kind, F.lit(NOW).cast("timestamp"))
    return x.select("tweet_id", "collected_at", "expired", "days_remaining")


def deletion_requests(s: SparkSession, d: str) -> DataFrame:
    u = table(s, d, "users").where("tweet_count = 0 and last_seen is not null")
    r = u.select(F.col("user_id_hash").alias("user"), F.col("last_seen").alias("requested_at"), F.lit(None).cast("timestamp").alias("completed_at"))
    return retention.pending(r, F.lit("2024-12-15").cast("timestamp")).select("user", "deadline", "days_remaining", "overdue")


def deletion_applied(s: SparkSession, d: str) -> DataFrame:
    gone = table(s, d, "users").where("tweet_count = 0").select(F.col("user_id_hash").alias("user"))
    return retention.without_deleted(table(s, d, "tweets"), "author_id_hash", gone).groupBy("author_id_hash").agg(F.count("*").alias("n"))


def stream_dedup(s: SparkSession, d: str) -> DataFrame:
    """Tweets as a stream: each id once within the watermark, appended to Parquet."""
    out = f"{checkpoint_dir(s)}/stream-{uuid.uuid4().hex}"
    source = s.readStream.schema(table(s, d, "tweets").schema).parquet(f"{d}/tweets*.parquet")
    rows = streaming.deduplicated(source, "tweet_id", "collected_at", "3650 days").select("tweet_id", "text_raw")
    streaming.append_to(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    folder = s._jvm.org.apache.hadoop.fs.Path(out)
    folder.getFileSystem(s._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return s.read.schema("tweet_id string, text_raw string").parquet(f"{out}/rows").select("tweet_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        gold_majority, gold_weighted, gold_average, agreement, annotation_stats, annotations_by_annotator, class_histogram, by_class_undersample, by_class_lists, by_class_oversample, political_labels,
        political_balance, split_random, split_stratified, sample_n, merge_by_id, merge_by_content, merge_input_order, store_query, normalize_tweets, count_by_day, count_by_hour_events, latest_tweets, user_counters, user_stats,
        catalog_page, catalog_stats, catalog_changes, catalog_lookup, metadata_fields, tweet_user_lookup, collection_counts, finance_candidates, finance_committees, finance_contributions, finance_by_name, finance_totals,
        retention_expired, deletion_requests, deletion_applied, stream_dedup,
    )
}

_CANON = "upper(regexp_replace(regexp_replace({0}, '^[\\s_-]+|[\\s_-]+$', '', 'g'), '[\\s_-]+', '_', 'g'))"
_LEAN = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in annotate.LEANING.items())
_SENT = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in annotate.SENTIMENT.items())
_ANN = f"""lv(k, v) AS (VALUES {_LEAN}), sv(k, v) AS (VALUES {_SENT}),
  a AS (SELECT item_id, annotator_id, seq, topics, is_political, coalesce(confidence, 1.0) AS w, CASE WHEN {_CANON.format('political_leaning')} IN ('UNKNOWN', (SELECT unnest(list(k)) FROM lv LIMIT 0)) OR {_CANON.format('political_leaning')} IN (SELECT k FROM lv) THEN {_CANON.format('political_leaning')} END AS l,
    CASE WHEN {_CANON.format('sentiment')} IN (SELECT k FROM sv) THEN {_CANON.format('sentiment')} END AS s FROM annotations WHERE item_id IS NOT NULL)"""
_ANN = _ANN.replace("IN ('UNKNOWN', (SELECT unnest(list(k)) FROM lv LIMIT 0))", "= 'UNKNOWN'")


def _mode(c: str, name: str) -> str:
    return f"{name} AS (SELECT item_id, {c} AS v FROM (SELECT item_id, {c}, count(*) AS n, min(seq) AS f FROM a WHERE {c} IS NOT NULL GROUP BY item_id, {c}) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n DESC, f) = 1)"


_HASH = "md5('42|' || {0})"
_LATEST = "latest AS (SELECT * FROM tweets QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY collected_at DESC) = 1)"
_SIDES = f"""{_LATEST}, sides AS (SELECT tweet_id, CASE WHEN l AND NOT r THEN 'left' WHEN r AND NOT l THEN 'right' WHEN NOT l AND NOT r THEN 'neutral' END AS political_label
  FROM (SELECT tweet_id, {" OR ".join(f"contains(lower(text_raw), '{w}')" for w in LEFT)} AS l, {" OR ".join(f"contains(lower(text_raw), '{w}')" for w in RIGHT)} AS r FROM latest))"""
_DAY = "coalesce(try_strptime(substr(contribution_date, 1, 10), '%Y-%m-%d')::DATE, try_strptime(contribution_date, '%m/%d/%Y')::DATE)"
_ONE = f"one AS (SELECT *, {_DAY} AS receipt_date FROM contributions QUALIFY row_number() OVER (PARTITION BY contribution_id ORDER BY contribution_id) = 1)"


def _split(strat: str, a: float, b: float) -> str:
    return f"""WITH r AS (SELECT doc_id, {strat} AS s, row_number() OVER (PARTITION BY {strat} ORDER BY {_HASH.format('doc_id')}, doc_id) AS k, count(*) OVER (PARTITION BY {strat}) AS n FROM documents)
      SELECT doc_id, CASE WHEN k <= floor(n * {a}::DOUBLE) THEN 'train' WHEN k <= floor(n * {a}::DOUBLE) + floor(n * {b}::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM r"""


ORACLES: dict[str, str] = {
    "gold_majority": f"""WITH {_ANN}, {_mode('l', 'ml')}, {_mode('s', 'ms')}, {_mode('is_political', 'mp')},
      tp AS (SELECT item_id, string_agg(DISTINCT t, ',' ORDER BY t) AS topics FROM (SELECT item_id, unnest(topics) AS t FROM a) GROUP BY 1), n AS (SELECT item_id, count(*) AS c FROM a GROUP BY 1)
      SELECT n.item_id, ml.v AS political_leaning, ms.v AS sentiment, mp.v AS is_political, coalesce(topics, '') AS topics, c AS annotation_count
      FROM n LEFT JOIN ml USING (item_id) LEFT JOIN ms USING (item_id) LEFT JOIN mp USING (item_id) LEFT JOIN tp USING (item_id)""",
    "gold_weighted": f"""WITH {_ANN} SELECT item_id, round(sum(lv.v * w) / sum(CASE WHEN lv.v IS NOT NULL THEN w END), 6) AS political_leaning, round(sum(sv.v * w) / sum(CASE WHEN sv.v IS NOT NULL THEN w END), 6) AS sentiment,
      sum(is_political::INTEGER * w) / sum(CASE WHEN is_political IS NOT NULL THEN w END) >= 0.5 AS is_political, count(*) AS annotation_count FROM a LEFT JOIN lv ON l = lv.k LEFT JOIN sv ON s = sv.k GROUP BY item_id""",
    "gold_average": f"WITH {_ANN} SELECT item_id, round(avg(lv.v), 6) AS political_leaning, round(avg(sv.v), 6) AS sentiment, count(*) AS annotation_count FROM a LEFT JOIN lv ON l = lv.k LEFT JOIN sv ON s = sv.k GROUP BY item_id",
    "agreement": f"""WITH {_ANN}, p AS (SELECT x.l AS xl, y.l AS yl, x.is_political AS xp, y.is_political AS yp FROM a x JOIN a y ON x.item_id = y.item_id AND x.seq < y.seq)
      SELECT (SELECT count(*) FROM (SELECT item_id FROM a GROUP BY 1 HAVING count(*) >= 2)) AS items_with_multiple_annotations, avg((xl = yl)::INTEGER) AS political_leaning_agreement, avg((xp = yp)::INTEGER) AS is_political_agreement, count(xl = yl) AS total_annotation_pairs FROM p""",
    "annotation_stats": "SELECT count(DISTINCT item_id) AS items, count(*) AS annotations, count(DISTINCT annotator_id) AS annotators, round(count(*) / count(DISTINCT item_id), 4) AS per_item FROM annotations",
    "annotations_by_annotator": f"WITH {_ANN} SELECT item_id, seq, l AS political_leaning, s AS sentiment FROM a WHERE annotator_id = 'ann-000001'",
    "class_histogram": "SELECT doc_type AS \"class\", count(*) AS n FROM documents WHERE doc_type IS NOT NULL GROUP BY 1",
    "by_class_undersample": f"SELECT doc_id, lang AS \"class\" FROM documents WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_HASH.format('doc_id')}, doc_id) <= 20",
    "by_class_lists": f"""WITH {_LATEST}, x AS (SELECT DISTINCT tweet_id, c FROM (SELECT tweet_id, unnest(political_topics) AS c FROM latest) WHERE c IS NOT NULL), z AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM x GROUP BY c))
      SELECT tweet_id, c AS "class" FROM x QUALIFY row_number() OVER (PARTITION BY c ORDER BY {_HASH.format('tweet_id')}, tweet_id) <= (SELECT n FROM z)""",
    "by_class_oversample": f"""WITH r AS (SELECT doc_id, lang AS c, row_number() OVER (PARTITION BY lang ORDER BY {_HASH.format('doc_id')}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IS NOT NULL),
      dr AS (SELECT c, n, i::INTEGER AS draw, ('0x' || substr(md5('42|' || c || '|' || i), 1, 12))::BIGINT % n + 1 AS k FROM (SELECT DISTINCT c, n FROM r WHERE n < 60) CROSS JOIN (SELECT unnest(range(1, 61)) AS i))
      SELECT doc_id, c AS "class", 1 AS draw FROM r WHERE n >= 60 AND k <= 60 UNION ALL SELECT doc_id, dr.c, draw FROM dr JOIN r USING (c, k)""",
    "political_labels": f"WITH {_SIDES} SELECT political_label, count(*) AS n FROM sides WHERE political_label IS NOT NULL GROUP BY 1",
    "political_balance": f"""WITH {_SIDES}, z AS (SELECT least(count(*) FILTER (political_label = 'left'), count(*) FILTER (political_label = 'right')) AS n FROM sides)
      SELECT tweet_id, political_label FROM sides WHERE political_label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY political_label ORDER BY {_HASH.format('tweet_id')}, tweet_id) <= (SELECT n FROM z)""",
    "split_random": _split("'all'", 0.8, 0.1),
    "split_stratified": _split("coalesce(nullif(lang, ''), 'unknown')", 0.7, 0.15),
    "sample_n": f"SELECT doc_id FROM documents ORDER BY {_HASH.format('doc_id')}, doc_id LIMIT 50",
    "merge_by_id": "SELECT tweet_id, collected_at, author_id_hash FROM tweets QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY collected_at) = 1",
    "merge_by_content": "SELECT md5(text) AS text_md5, lang FROM (SELECT DISTINCT text, lang FROM documents)",
    "merge_input_order": """WITH t AS (SELECT *, row_number() OVER () AS place FROM tweets), u AS (SELECT *, 0 AS f FROM t WHERE lang = 'en' UNION ALL SELECT *, 1 AS f FROM t)
      SELECT tweet_id, collected_at, author_id_hash FROM u QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY f, place) = 1""",
    "store_query": "SELECT tweet_id, collected_at, created_at, political_score::DOUBLE AS political_score FROM tweets WHERE created_at >= '2024-03-01' AND created_at <= '2024-09-30' AND political_score >= 0.5 AND NOT isnan(political_score) AND lang = 'en'",
    "normalize_tweets": "SELECT tweet_id, collected_at, created_at, lang, false AS is_reply, like_count, 'all' AS collection_query, 0 AS tags FROM tweets",
    "count_by_day": "SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS n FROM tweets WHERE created_at IS NOT NULL GROUP BY 1",
    "count_by_hour_events": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
    "latest_tweets": f"WITH {_LATEST} SELECT tweet_id, collected_at, author_id_hash, like_count FROM latest",
    "user_counters": "SELECT author_id_hash AS user_id_hash, count(*) AS tweet_count, min(collected_at) AS first_seen, max(collected_at) AS last_seen FROM tweets WHERE author_id_hash IS NOT NULL GROUP BY 1",
    "user_stats": "SELECT count(*) AS users, coalesce(sum(tweet_count), 0)::BIGINT AS tweets, round(avg(tweet_count), 2) AS avg_tweets FROM users",
    "catalog_page": "SELECT id, name, created_at FROM collections WHERE status = 'completed' ORDER BY created_at DESC, id DESC LIMIT 5 OFFSET 5",
    "catalog_stats": "SELECT count(*) AS collections, count(*) FILTER (status = 'completed') AS completed, coalesce(sum(tweet_count), 0)::BIGINT AS collected, (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM (SELECT DISTINCT collection_query, date_trunc('day', collected_at) FROM tweets)) AS queries FROM collections",
    "catalog_changes": """SELECT id, name, CASE WHEN end_date IS NULL THEN 'open' ELSE status END AS status, tweet_count, CASE WHEN end_date IS NULL THEN 'no end' END AS note FROM collections WHERE status IS DISTINCT FROM 'failed'""",
    "catalog_lookup": "SELECT id, name, query, status FROM collections WHERE name = 'river_levy_2024' ORDER BY id LIMIT 1",
    "metadata_fields": "SELECT field, count(*) AS users FROM (SELECT unnest(json_keys(metadata)) AS field FROM users WHERE metadata IS NOT NULL) GROUP BY 1",
    "tweet_user_lookup": "SELECT tweet_id, collected_at, u.tweet_count FROM tweets t LEFT JOIN users u ON t.author_id_hash = u.user_id_hash",
    "collection_counts": "SELECT c.id, c.tweet_count, count(DISTINCT t.tweet_id) AS tweets FROM collections c LEFT JOIN tweets t ON t.collection_query = c.query GROUP BY ALL",
    "finance_candidates": "SELECT candidate_id, name, state FROM candidates WHERE list_contains(election_years, 2024) AND office = 'S'",
    "finance_committees": "SELECT committee_id, name, committee_type FROM committees WHERE contains(lower(name), 'citizens') AND committee_type IN ('N', 'H', 'S')",
    "finance_contributions": f"WITH {_ONE} SELECT contribution_id, contribution_amount, receipt_date::VARCHAR AS receipt_date FROM one WHERE committee_id = 'C40000001' AND contribution_amount BETWEEN 25 AND 500 AND year(receipt_date) IN (2023, 2024)",
    "finance_by_name": f"WITH {_ONE} SELECT contribution_id, receipt_date::VARCHAR AS receipt_date FROM one WHERE contains(lower(contributor_name), 'conduit') ORDER BY one.receipt_date DESC NULLS LAST, contribution_id LIMIT 100",
    "finance_totals": f"WITH {_ONE} SELECT candidate_id, round(sum(contribution_amount), 2) AS receipts, count(*) AS contributions, count(DISTINCT contributor_name) AS contributors, max(contribution_amount) AS largest FROM one WHERE candidate_id IS NOT NULL GROUP BY 1",
    "retention_expired": f"""WITH e AS (SELECT tweet_id, collected_at, collected_at + to_days(CASE WHEN text_clean IS NOT NULL THEN 730 ELSE 365 END) AS x FROM tweets)
      SELECT tweet_id, collected_at, TIMESTAMPTZ '{NOW}+00' > x AS expired, CASE WHEN TIMESTAMPTZ '{NOW}+00' > x THEN 0 ELSE floor((floor(epoch(x)) - epoch(TIMESTAMPTZ '{NOW}+00')) / 86400)::BIGINT END AS days_remaining FROM e""",
    "deletion_requests": """WITH r AS (SELECT user_id_hash AS "user", last_seen + to_days(30) AS deadline FROM users WHERE tweet_count = 0 AND last_seen IS NOT NULL), f AS (SELECT *, floor((floor(epoch(deadline)) - epoch(TIMESTAMPTZ '2024-12-15 00:00:00+00')) / 86400)::BIGINT AS n FROM r)
      SELECT "user", deadline, greatest(n, 0) AS days_remaining, n < 0 AS overdue FROM f""",
    "deletion_applied": "SELECT author_id_hash, count(*) AS n FROM tweets WHERE author_id_hash NOT IN (SELECT user_id_hash FROM users WHERE tweet_count = 0 AND user_id_hash IS NOT NULL) GROUP BY 1",
    "stream_dedup": "SELECT DISTINCT tweet_id FROM tweets",
}
