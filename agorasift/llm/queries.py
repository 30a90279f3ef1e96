"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorasift.llm import capping, consensus, cross_split, grouped_split, leaks, name_links, packing, personal_info, sentences, visible_text
from agorasift.sources.tables import spread, table

CAP = 30
#: The vocabulary of a public tokenizer as the driver lays it out; a parameter of the operator.
TOKENIZER = os.environ.get("AGORASIFT_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: An annotator whose skill above chance is below this is unreliable; chance is 0, the usual annotator has 0.6 and more.
UNRELIABLE = 0.25


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return visible_text.found(table(spark, d, "tweets"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    return visible_text.classes(table(spark, d, "tweets"))


def p1_consistent_tags(spark: SparkSession, d: str) -> DataFrame:
    return visible_text.consistent_tags(table(spark, d, "tweets"))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return personal_info.found_spans(table(spark, d, "tweets"), table(spark, d, "contributions"), table(spark, d, "candidates"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).select("tweet_id", "pii_type", "pii_text").distinct()


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal_info.redact(table(spark, d, "tweets"), _spans(spark, d))


def p8_windows(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), table(spark, d, "context_windows"), path=TOKENIZER)


def p8_bounded(spark: SparkSession, d: str) -> DataFrame:
    """Windows in which attention (a quarter of capacity squared) and the number of documents (one in 256 tokens) bind beside tokens."""
    return packing.pack(table(spark, d, "documents"), table(spark, d, "context_windows"), path=TOKENIZER, attention_share=0.25, tokens_per_doc=256, rule="dot")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_windows(spark, d), table(spark, d, "context_windows"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(spread(table(spark, d, "documents").select("doc_id", "text")), table(spark, d, "eval_items")).select("item_id", "doc_id")


def p9_verbatim(spark: SparkSession, d: str) -> DataFrame:
    return leaks.verbatim(spread(table(spark, d, "documents").select("doc_id", "text")), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(spread(table(spark, d, "documents").select("doc_id", "text")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    labels, annotators = consensus.consensus(table(spark, d, "annotations"))
    a = labels.select("kind", F.col("item_id").alias("subject_id"), "label")
    b = annotators.where(F.col("skill") < UNRELIABLE).select(F.lit("unreliable").alias("kind"), F.col("annotator_id").alias("subject_id"), F.lit("").alias("label"))
    return a.unionByName(b)


def p2_item_agreement(spark: SparkSession, d: str) -> DataFrame:
    x = consensus.item_agreement(table(spark, d, "annotations"))
    return x.select("kind", "item_id", "raters", *[F.round(c, 6).alias(c) for c in ("observed", "expected", "kappa")])


def p2_annotator_reliability(spark: SparkSession, d: str) -> DataFrame:
    _, x = consensus.consensus(table(spark, d, "annotations"))
    return x.select("annotator_id", "n", F.round("hits", 3).alias("hits"), F.round("expected", 3).alias("expected"), F.round("skill", 4).alias("skill"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.found(table(spark, d, "tweets"), table(spark, d, "split_assignments"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.report(table(spark, d, "tweets"), table(spark, d, "split_assignments"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.classes(table(spark, d, "tweets"), table(spark, d, "split_assignments"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    groups, _ = grouped_split.author_groups(table(spark, d, "tweets"), table(spark, d, "users"))
    return groups.where("members > 1").select("author_id_hash", "group_key")


def p5_assignment(spark: SparkSession, d: str) -> DataFrame:
    return grouped_split.split_together(table(spark, d, "tweets"), table(spark, d, "users"))


def p5_forest(spark: SparkSession, d: str) -> DataFrame:
    """The ties that hold the groups together: a spanning forest of authors, accounts and operators."""
    return grouped_split.author_groups(table(spark, d, "tweets"), table(spark, d, "users"))[1]


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return capping.latest_rows(table(spark, d, "tweets"), "tweet_id", "collected_at", ["author_id_hash", "political_score", "created_at"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _latest(spark, d)
    kept = capping.cap_contributors(rows, id_col="tweet_id", contributor="author_id_hash", quality="political_score", cap=CAP)
    return capping.dropped(rows, kept, "tweet_id")


def p6_by_month(spark: SparkSession, d: str) -> DataFrame:
    """The cap dealt over the months of each author's tweets."""
    rows = _latest(spark, d)
    month = F.date_format("created_at", "yyyy-MM")
    kept = capping.cap_contributors(rows, id_col="tweet_id", contributor="author_id_hash", quality="political_score", cap=CAP, strata=month)
    return kept.select("tweet_id", "author_id_hash", F.col("stratum").alias("month"), "place")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return name_links.found(table(spark, d, "contributions"))


def p7_entities(spark: SparkSession, d: str) -> DataFrame:
    x = name_links.linked_contributions(table(spark, d, "contributions"))
    return x.select("contribution_id", "contributor_name", F.min("contribution_id").over(Window.partitionBy("entity")).alias("entity"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_forms, p1_consistent_tags, p2_found, p2_item_agreement, p2_annotator_reliability, p3_found, p3_redacted, p4_found, p4_report, p4_classes, p5_found, p5_assignment, p5_forest, p6_found, p6_by_month,
        p7_found, p7_entities, p8_windows, p8_bounded, p8_fill, p9_found, p9_verbatim, p10_found,
    )
}

_LATEST = """latest AS (SELECT tweet_id, author_id_hash AS a, political_score AS q, created_at FROM tweets
  QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY collected_at DESC) = 1)"""
_BEST = "CASE WHEN q IS NULL OR isnan(q) THEN 0 ELSE 1 END DESC, CASE WHEN q IS NULL OR isnan(q) THEN 0 ELSE q END DESC, tweet_id"

ORACLES: dict[str, str] = {
    "p9_verbatim": "SELECT DISTINCT item_id, doc_id FROM eval_items JOIN documents ON contains(text, passage)",
    "p6_found": f"WITH {_LATEST} SELECT tweet_id FROM latest QUALIFY row_number() OVER (PARTITION BY a ORDER BY {_BEST}) > {CAP}",
    "p6_by_month": f"""WITH {_LATEST}, m AS (SELECT *, strftime(created_at, '%Y-%m') AS s FROM latest),
      n AS (SELECT a, s, count(*) AS n FROM m GROUP BY a, s), t AS (SELECT *, sum(n) OVER (PARTITION BY a) AS t FROM n),
      sh AS (SELECT *, CASE WHEN t <= {CAP} THEN n::DOUBLE ELSE {CAP} * n::DOUBLE / t END AS sh FROM t),
      w AS (SELECT *, floor(sh + 1e-9) AS w, least({CAP}, t) AS c FROM sh),
      r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sh - w DESC, s NULLS FIRST) AS turn, c - sum(w) OVER (PARTITION BY a) AS over FROM w),
      slots AS (SELECT a, s, w + CASE WHEN turn <= over THEN 1 ELSE 0 END AS slots FROM r),
      k AS (SELECT tweet_id, a, s, row_number() OVER (PARTITION BY a, s ORDER BY {_BEST})::INTEGER AS place FROM m)
      SELECT tweet_id, k.a AS author_id_hash, k.s AS month, place FROM k JOIN slots ON k.a = slots.a AND k.s IS NOT DISTINCT FROM slots.s WHERE place <= slots""",
    "p5_found": """WITH RECURSIVE u AS (SELECT user_id_hash AS a, metadata AS m FROM users WHERE metadata IS NOT NULL),
      op AS (SELECT a, lower(trim(o)) AS o FROM (SELECT a, json_extract_string(m, '$.operator') AS o FROM u UNION ALL SELECT a, json_extract_string(m, '$.team.operator') FROM u)),
      e0 AS (SELECT a, json_extract_string(m, '$.renamed_from') AS b FROM u UNION ALL
        SELECT a, unnest(CAST(json_extract(m, '$.also_posts_as') AS VARCHAR[])) FROM u WHERE json_type(m, '$.also_posts_as') = 'ARRAY' UNION ALL
        SELECT a, 'op:' || o FROM op WHERE o NOT IN ('', 'unknown', 'none', 'n/a', 'self') UNION ALL
        SELECT DISTINCT x.author_id_hash, y.author_id_hash FROM tweets x JOIN tweets y ON x.tweet_id = y.tweet_id AND x.author_id_hash < y.author_id_hash),
      e AS (SELECT a, b FROM e0 WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e0 WHERE a IS NOT NULL AND b IS NOT NULL),
      r AS (SELECT DISTINCT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
      present AS (SELECT DISTINCT author_id_hash AS b FROM tweets),
      g AS (SELECT r.a, min(r.b) AS k, count(*) AS n FROM r JOIN present USING (b) GROUP BY r.a)
      SELECT a AS author_id_hash, k AS group_key FROM g JOIN present ON a = present.b WHERE n > 1""",
    "p2_item_agreement": """WITH cur AS (SELECT * FROM annotations QUALIFY row_number() OVER (PARTITION BY item_id, annotator_id ORDER BY created_at DESC NULLS LAST, seq DESC) = 1),
      lab AS (SELECT item_id, 'political_leaning' AS kind, upper(regexp_replace(trim(political_leaning), '[\\s_-]+', '_', 'g')) AS l FROM cur UNION ALL
        SELECT item_id, 'sentiment', upper(regexp_replace(trim(sentiment), '[\\s_-]+', '_', 'g')) FROM cur),
      ok AS (SELECT * FROM lab WHERE l IS NOT NULL AND l <> 'UNKNOWN'),
      c AS (SELECT kind, item_id, l, count(*) AS n FROM ok GROUP BY ALL),
      i AS (SELECT kind, item_id, sum(n)::BIGINT AS raters, sum(n * (n - 1)) AS same FROM c GROUP BY ALL),
      f AS (SELECT kind, l, sum(n)::DOUBLE AS m FROM c GROUP BY ALL), x AS (SELECT kind, sum(m * m) / (sum(m) * sum(m)) AS e FROM f GROUP BY kind)
      SELECT kind, item_id, raters, round(same / (raters * (raters - 1)), 6) AS observed, round(e, 6) AS expected,
        round((same / (raters * (raters - 1)) - e) / (1 - e), 6) AS kappa FROM i JOIN x USING (kind) WHERE raters >= 2""",
}
