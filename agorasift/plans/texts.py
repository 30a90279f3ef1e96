"""Queries of the text operators: cleaning, tokens, keywords, entities, classification, privacy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorasift.operators import classify, clean, entities, keywords, privacy, tokens
from agorasift.sources.tables import spread, table

SALT = "pepper"
KEY = ["tweet_id", "collected_at"]
#: The cleaner with every stage off that can be: it squeezes repeated marks only.
BARE = clean.CleanConfig(unescape_html=False, normalize_unicode=False, remove_retweet_prefix=False, remove_urls=False, normalize_hashtags=False, normalize_whitespace=False, detect_language=False)


def tweets(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "tweets").select(*KEY, "text_raw", "author_id_hash", "lang", "created_at", "hashtags", "mentions"))


def dictionary(spark: SparkSession, d: str) -> DataFrame:
    """The built-in keywords, and from the tables: candidates, their parties, the topics of the collections."""
    one = table(spark, d, "candidates").where("name is not null").select(F.lower("name").alias("keyword"), F.lit("politicians").alias("category"), F.lit("candidates").alias("subcategory"), F.lit(2.0).alias("weight"))
    two = table(spark, d, "candidates").where("party is not null").select(F.lower("party").alias("keyword"), F.lit("parties").alias("category"), F.lit("organisations").alias("subcategory"), F.lit(1.5).alias("weight"))
    topic = F.regexp_replace(F.regexp_replace("name", r"_[0-9]+$", ""), "_", " ")
    three = table(spark, d, "collections").select(topic.alias("keyword"), F.lit("topics").alias("category"), F.lit("collections").alias("subcategory"), F.lit(1.0).alias("weight"))
    own = one.unionByName(two).unionByName(three).withColumn("o", F.lit(1))
    every = keywords.built_in(spark).withColumn("o", F.lit(0)).unionByName(own)
    return keywords.last_wins(every, F.struct("o", "category", "subcategory"))


def gazetteer(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "candidates").select("name", F.lit("PERSON").alias("label"))
    parties = table(spark, d, "candidates").where("party is not null").select(F.col("party").alias("name"), F.lit("ORG").alias("label"))
    groups = table(spark, d, "committees").select("name", F.lit("ORG").alias("label"))
    return people.unionByName(parties).unionByName(groups).where("name is not null").distinct()


def clean_urls(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.strip_urls(F.col("text_raw")).alias("cleaned"))


def clean_forward_prefix(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.strip_forward(F.col("text_raw")).alias("cleaned"))


def clean_mentions(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.strip_mentions(F.col("text_raw")).alias("cleaned"))


def clean_hashtags(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.plain_hashtags(F.col("text_raw")).alias("cleaned"))


def clean_repeated_marks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", clean.squeeze_marks(F.col("text")).alias("cleaned"))


def clean_whitespace(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", clean.squeeze_space(F.col("text")).alias("cleaned"))


def clean_lower_truncate(s: SparkSession, d: str) -> DataFrame:
    cfg = replace(BARE, lowercase=True, max_length=100)
    return clean.clean(table(s, d, "documents"), "text", cfg).select("doc_id", "cleaning.cleaned")


def clean_emoji(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.strip_emoji(F.col("text_raw")).alias("cleaned"), clean.count_emoji(F.col("text_raw")).cast("long").alias("emoji"))


def clean_html(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, clean.unescape_html(F.col("text_raw")).alias("cleaned"))


def clean_pipeline(s: SparkSession, d: str) -> DataFrame:
    rows = clean.keep_clean(tweets(s, d), "text_raw", "all")
    c = F.col("cleaning")
    return rows.select(*KEY, c["cleaned"].alias("cleaned"), c["language"].alias("language"), F.size(c["removed_urls"]).alias("urls"), F.size(c["hashtags"]).alias("tags"), c["emoji_count"].cast("int").alias("emoji"))


def clean_pipeline_english(s: SparkSession, d: str) -> DataFrame:
    rows = clean.keep_clean(tweets(s, d), "text_raw", "en")
    return rows.select(*KEY, F.length("cleaning.cleaned").alias("chars"))


def extract_urls(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, F.posexplode(clean.extract_urls(F.col("text_raw"))).alias("at", "url"))


def extract_mentions(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, F.posexplode(clean.extract_mentions(F.col("text_raw"))).alias("at", "mention"))


def extract_hashtags(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, F.posexplode(clean.extract_hashtags(F.col("text_raw"))).alias("at", "tag"))


def hashtag_words(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(F.explode("hashtags").alias("tag")).distinct().select("tag", clean.hashtag_words(F.col("tag")).alias("words"))


def filter_min_length(s: SparkSession, d: str) -> DataFrame:
    rows = clean.keep_clean(table(s, d, "documents"), "text", "all", replace(BARE, min_length=200))
    return rows.select("doc_id", F.length("cleaning.cleaned").alias("chars"))


def filter_language(s: SparkSession, d: str) -> DataFrame:
    return clean.of_language(tweets(s, d), "de").select(*KEY, "text_raw")


def language_guess(s: SparkSession, d: str) -> DataFrame:
    guess = table(s, d, "documents").select("lang", clean.guess_language(F.col("text")).alias("guess"))
    return guess.groupBy("lang", "guess").agg(F.count("*").alias("n"))


def stats_text_length(s: SparkSession, d: str) -> DataFrame:
    return clean.text_stats(table(s, d, "documents"))


def stats_language_top10(s: SparkSession, d: str) -> DataFrame:
    return clean.histogram(table(s, d, "tweets"), "lang", 10)


def stats_score(s: SparkSession, d: str) -> DataFrame:
    return clean.number_stats(table(s, d, "tweets"), "political_score")


def stats_topics(s: SparkSession, d: str) -> DataFrame:
    return clean.histogram(table(s, d, "tweets").select(F.explode("political_topics").alias("topic")), "topic")


def tokens_counts(s: SparkSession, d: str) -> DataFrame:
    t = tokens.tokenized(F.col("text"))
    return table(s, d, "documents").withColumn("t", t).select("doc_id", "t.token_count", "t.filtered_count", "t.sentence_count")


def ngrams_top(s: SparkSession, d: str) -> DataFrame:
    """The fifty most frequent pairs of white-space words of the tweets."""
    words = F.filter(F.split(F.lower("text_raw"), " "), lambda w: w != "")
    pairs = tweets(s, d).select(F.explode(tokens.ngrams(words, 2)).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return pairs.orderBy(F.desc("n"), "pair").limit(50)


def sentence_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.size(tokens.sentence_parts(F.col("text"))).alias("sentences"))


def dictionary_stats(s: SparkSession, d: str) -> DataFrame:
    return keywords.dictionary_stats(dictionary(s, d))


def keyword_matches(s: SparkSession, d: str) -> DataFrame:
    m = keywords.match(tweets(s, d), dictionary(s, d), "text_raw")
    return m.select(*KEY, F.explode("matches").alias("m")).select(*KEY, F.lower("m.keyword").alias("keyword"), "m.category", "m.start", "m.end")


def _scored(s: SparkSession, d: str) -> DataFrame:
    m = keywords.match(tweets(s, d), dictionary(s, d), "text_raw")
    return m.withColumn("s", keywords.score(F.col("matches"), F.col("text_raw")))


def keyword_score(s: SparkSession, d: str) -> DataFrame:
    return _scored(s, d).select(*KEY, "s.total_score", "s.match_count", "s.weight")


def keyword_categories(s: SparkSession, d: str) -> DataFrame:
    rows = _scored(s, d).select(F.explode("s.raw_category_scores").alias("category", "w"))
    return rows.groupBy("category").agg(F.count("*").alias("tweets"), F.sum("w").alias("weight"))


def keyword_context(s: SparkSession, d: str) -> DataFrame:
    m = keywords.match(tweets(s, d), dictionary(s, d), "text_raw")
    c = keywords.with_context(F.col("matches"), F.col("text_raw"), 20)
    return m.select(*KEY, F.explode(c).alias("m")).select(*KEY, "m.start", "m.context")


def detect_threshold(s: SparkSession, d: str) -> DataFrame:
    return classify.detect(tweets(s, d), dictionary(s, d), "text_raw", 20.0).select(*KEY, "score.total_score", F.array_join("categories", ",").alias("categories"))


def classify_scores(s: SparkSession, d: str) -> DataFrame:
    """Relevance from keywords alone (no entities), with its confidence."""
    rows = classify.classify(tweets(s, d), dictionary(s, d), text="text_raw")
    return rows.select(*KEY, "political.is_political", "political.score", "political.confidence", F.array_join("political.topics", ",").alias("topics"))


def classify_with_entities(s: SparkSession, d: str) -> DataFrame:
    rows = classify.classify(tweets(s, d), dictionary(s, d), gazetteer(s, d), "text_raw")
    return rows.select(*KEY, "political.is_political", "political.score", "political.entity_score", F.size("entities").alias("entities"))


def entity_types(s: SparkSession, d: str) -> DataFrame:
    """Political types of the committees, parties and offices of the tables."""
    a = table(s, d, "committees").select(F.lit("ORG").alias("label"), F.col("name").alias("text"), F.lit("").alias("before"))
    b = table(s, d, "candidates").select(F.lit("PERSON").alias("label"), F.col("name").alias("text"), F.when(F.col("office") == "S", "said Senator").otherwise("said citizen").alias("before"))
    c = table(s, d, "candidates").select(F.lit("GPE").alias("label"), F.col("state").alias("text"), F.lit("in").alias("before")).distinct()
    rows = a.unionByName(b).unionByName(c)
    return rows.select("label", "text", entities.political_type(F.col("label"), F.col("text"), F.col("before")).alias("political_type"))


def entity_summary(s: SparkSession, d: str) -> DataFrame:
    x = entities.recognize(tweets(s, d), gazetteer(s, d), "text_raw").withColumn("s", entities.summary(F.col("entities")))
    return x.select(*KEY, "s.total_entities", "s.political_entities")


def contains_pii(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).where(privacy.contains_pii(F.col("text_raw"))).select(*KEY)


def pii_types(s: SparkSession, d: str) -> DataFrame:
    found = privacy.detect(tweets(s, d), "text_raw").select(F.explode("pii").alias("p"))
    return found.groupBy("p.pii_type").agg(F.count("*").alias("n"))


def redact_email_ip(s: SparkSession, d: str) -> DataFrame:
    return tweets(s, d).select(*KEY, privacy.redact_column(F.col("text_raw")).alias("text"))


def redact_all(s: SparkSession, d: str) -> DataFrame:
    return privacy.redact(tweets(s, d), "text_raw").select(*KEY, "redacted", F.array_join("pii_types", ",").alias("pii_types"))


def hash_authors(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "tweets").select("author_id_hash").distinct()
    return a.select("author_id_hash", privacy.hash_user_id(F.col("author_id_hash"), SALT).alias("uid"), privacy.hash_username(F.col("author_id_hash"), SALT, algorithm="md5").alias("name"))


def pseudonym_rank(s: SparkSession, d: str) -> DataFrame:
    return privacy.pseudonyms(table(s, d, "tweets"), "author_id_hash", "collected_at")


def anonymize_items(s: SparkSession, d: str) -> DataFrame:
    items = tweets(s, d).select(*KEY, F.col("author_id_hash").alias("author_id"), F.lit("@someone").alias("author_username"), F.lit("Some One").alias("author_name"), "mentions")
    out = privacy.anonymize_items(items, SALT)
    return out.select(*KEY, "author_id_hash", "author_username_hash", F.array_join("mentions_hashes", ",").alias("mentions_hashes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        clean_urls, clean_forward_prefix, clean_mentions, clean_hashtags, clean_repeated_marks, clean_whitespace, clean_lower_truncate, clean_emoji, clean_html, clean_pipeline, clean_pipeline_english,
        extract_urls, extract_mentions, extract_hashtags, hashtag_words, filter_min_length, filter_language, language_guess, stats_text_length, stats_language_top10, stats_score, stats_topics,
        tokens_counts, ngrams_top, sentence_counts, dictionary_stats, keyword_matches, keyword_score, keyword_categories, keyword_context, detect_threshold, classify_scores, classify_with_entities,
        entity_types, entity_summary, contains_pii, pii_types, redact_email_ip, redact_all, hash_authors, pseudonym_rank, anonymize_items,
    )
}

_W = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]"
_S = r"[\s\p{Z}\x{85}\x{0B}]"
_URL = r"""(?:https?://[^\s\p{Z}\x{85}\x{0B}<>"{}|\\^`\[\]]+|www\.[^\s\p{Z}\x{85}\x{0B}<>"{}|\\^`\[\]]+)"""
_EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
_BUILT = ", ".join(f"('{w.lower()}', '{c}', NULL, {weight}, 0)" for c, (weight, ws) in keywords.BUILT_IN.items() for w in ws.split())
_DICT = f"""dict0(keyword, category, subcategory, weight, o) AS (VALUES {_BUILT}), dict1 AS (SELECT * FROM dict0
    UNION SELECT lower(name), 'politicians', 'candidates', 2.0, 1 FROM candidates WHERE name IS NOT NULL
    UNION SELECT lower(party), 'parties', 'organisations', 1.5, 1 FROM candidates WHERE party IS NOT NULL
    UNION SELECT lower(replace(regexp_replace(name, '_[0-9]+$', ''), '_', ' ')), 'topics', 'collections', 1.0, 1 FROM collections),
  dict AS (SELECT keyword, category, subcategory, weight::DOUBLE AS weight FROM dict1 QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY o DESC, category DESC, subcategory DESC) = 1)"""
_GREEDY = f"""{_DICT}, t AS (SELECT tweet_id, collected_at, text_raw, lower(text_raw) AS low FROM tweets),
  c AS (SELECT tweet_id, collected_at, low, keyword, category, subcategory, weight FROM t JOIN dict ON contains(low, keyword)),
  p AS (SELECT *, unnest(range(1, length(low) - length(keyword) + 2)) AS i FROM c),
  occ AS (SELECT tweet_id, collected_at, keyword, category, subcategory, weight, (i - 1)::INTEGER AS st, (i - 1 + length(keyword))::INTEGER AS en FROM p WHERE substr(low, i, length(keyword)) = keyword),
  num AS (SELECT *, row_number() OVER (PARTITION BY tweet_id, collected_at ORDER BY en, st) AS rn FROM occ),
  g AS (SELECT tweet_id, collected_at, 0::BIGINT AS rn, 0 AS last, false AS taken FROM (SELECT DISTINCT tweet_id, collected_at FROM num)
    UNION ALL SELECT n.tweet_id, n.collected_at, n.rn, CASE WHEN n.st >= g.last THEN n.en ELSE g.last END, n.st >= g.last FROM g JOIN num n ON n.tweet_id = g.tweet_id AND n.collected_at = g.collected_at AND n.rn = g.rn + 1),
  m AS (SELECT n.* FROM num n JOIN g USING (tweet_id, collected_at, rn) WHERE g.taken),
  s AS (SELECT t.tweet_id, t.collected_at, t.text_raw, coalesce(sum(weight), 0.0) AS w, count(m.keyword) AS k FROM t LEFT JOIN m USING (tweet_id, collected_at) GROUP BY ALL)"""
_SCORE = "round(w * 1000 / greatest(length(text_raw), 1), 4)"
_PII = {"EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b"}
_EVERY = "tweet_id, collected_at"


def _extract(pattern: str, group: int, name: str) -> str:
    return f"SELECT {_EVERY}, (generate_subscripts(l, 1) - 1)::INTEGER AS at, unnest(l) AS {name} FROM (SELECT {_EVERY}, regexp_extract_all(text_raw, '{pattern}', {group}) AS l FROM tweets) WHERE len(l) > 0"


ORACLES: dict[str, str] = {
    "clean_urls": f"SELECT {_EVERY}, regexp_replace(text_raw, '{_URL}', ' ', 'g') AS cleaned FROM tweets",
    "clean_forward_prefix": f"SELECT {_EVERY}, regexp_replace(text_raw, '^RT{_S}*@{_W}+:{_S}*', '', 'i') AS cleaned FROM tweets",
    "clean_mentions": f"SELECT {_EVERY}, regexp_replace(text_raw, '@{_W}+', ' ', 'g') AS cleaned FROM tweets",
    "clean_hashtags": f"SELECT {_EVERY}, regexp_replace(text_raw, '#({_W}+)', '\\1', 'g') AS cleaned FROM tweets",
    "clean_repeated_marks": "SELECT doc_id, regexp_replace(text, '([!?.]){2,}', '\\1', 'g') AS cleaned FROM documents",
    "clean_whitespace": f"SELECT doc_id, trim(regexp_replace(text, '{_S}+', ' ', 'g'), ' ') AS cleaned FROM documents",
    "clean_lower_truncate": "SELECT doc_id, substr(lower(regexp_replace(text, '([!?.]){2,}', '\\1', 'g')), 1, 100) AS cleaned FROM documents",
    "clean_emoji": f"SELECT {_EVERY}, regexp_replace(text_raw, '{_EMOJI}', ' ', 'g') AS cleaned, len(regexp_extract_all(text_raw, '{_EMOJI}')) AS emoji FROM tweets",
    "clean_html": f"SELECT {_EVERY}, replace(replace(replace(replace(replace(text_raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&') AS cleaned FROM tweets",
    "extract_urls": _extract(_URL, 0, "url"),
    "extract_mentions": _extract(f"@({_W}+)", 1, "mention"),
    "extract_hashtags": _extract(f"#({_W}+)", 1, "tag"),
    "hashtag_words": f"SELECT DISTINCT tag, lower(trim(regexp_replace(replace(regexp_replace(regexp_replace(tag, '^#+', ''), '([A-Z])', ' \\1', 'g'), '_', ' '), '{_S}+', ' ', 'g'), ' ')) AS words FROM (SELECT unnest(hashtags) AS tag FROM tweets)",
    "filter_min_length": "SELECT doc_id, length(regexp_replace(text, '([!?.]){2,}', '\\1', 'g'))::INTEGER AS chars FROM documents WHERE length(regexp_replace(text, '([!?.]){2,}', '\\1', 'g')) >= 200",
    "filter_language": f"SELECT {_EVERY}, text_raw FROM tweets WHERE lang = 'de'",
    "stats_text_length": "SELECT count(*) AS items, min(length(text))::INTEGER AS min_length, max(length(text))::INTEGER AS max_length, round(avg(length(text)), 4) AS avg_length FROM documents",
    "stats_language_top10": "SELECT coalesce(lang, 'unknown') AS value, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM tweets GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
    "stats_score": "SELECT count(*) AS n, min(v) AS least, max(v) AS most, round(avg(v), 6) AS mean FROM (SELECT political_score::DOUBLE AS v FROM tweets WHERE political_score IS NOT NULL AND NOT isnan(political_score))",
    "stats_topics": "SELECT coalesce(t, 'unknown') AS value, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM (SELECT unnest(political_topics) AS t FROM tweets) GROUP BY 1",
    "ngrams_top": """WITH w AS (SELECT row_number() OVER () AS r, list_filter(string_split(lower(text_raw), ' '), lambda x: x <> '') AS l FROM tweets),
      p AS (SELECT l, unnest(range(1, len(l))) AS i FROM w) SELECT l[i] || ' ' || l[i + 1] AS pair, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, pair LIMIT 50""",
    "sentence_counts": "SELECT doc_id, len(list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> ''))::INTEGER AS sentences FROM documents WHERE text IS NOT NULL",
    "dictionary_stats": f"WITH {_DICT} SELECT category, count(DISTINCT keyword) AS keywords, count(DISTINCT subcategory) AS subcategories, max(weight) AS weight FROM dict GROUP BY 1",
    "keyword_matches": f"WITH RECURSIVE {_GREEDY} SELECT {_EVERY}, keyword, category, st AS start, en AS \"end\" FROM m",
    "keyword_score": f"WITH RECURSIVE {_GREEDY} SELECT {_EVERY}, {_SCORE} AS total_score, k::INTEGER AS match_count, w AS weight FROM s",
    "keyword_categories": f"WITH RECURSIVE {_GREEDY} SELECT category, count(*) AS tweets, sum(w) AS weight FROM (SELECT {_EVERY}, category, sum(weight) AS w FROM m GROUP BY ALL) GROUP BY category",
    "keyword_context": f"WITH RECURSIVE {_GREEDY} SELECT {_EVERY}, st AS start, CASE WHEN st > 20 THEN '...' ELSE '' END || substr(t.text_raw, greatest(0, st - 20) + 1, least(length(t.text_raw), en + 20) - greatest(0, st - 20)) || CASE WHEN en + 20 < length(t.text_raw) THEN '...' ELSE '' END AS context FROM m JOIN t USING ({_EVERY})",
    "detect_threshold": f"WITH RECURSIVE {_GREEDY}, cats AS (SELECT {_EVERY}, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM m GROUP BY ALL) SELECT {_EVERY}, {_SCORE} AS total_score, coalesce(categories, '') AS categories FROM s LEFT JOIN cats USING ({_EVERY}) WHERE {_SCORE} >= 20",
    "classify_scores": f"""WITH RECURSIVE {_GREEDY}, f AS (SELECT *, {_SCORE} AS kw, least(1.0, ({_SCORE} * 0.6 + 0.0 * 0.4) / 10) AS x FROM s),
      tops AS (SELECT {_EVERY}, string_agg(DISTINCT c, ',' ORDER BY c) AS topics FROM (SELECT {_EVERY}, category AS c FROM m UNION SELECT {_EVERY}, subcategory FROM m WHERE subcategory IS NOT NULL) GROUP BY ALL)
      SELECT {_EVERY}, x >= 0.3 AS is_political, round(x, 4) AS score,
        round(least(1.0, CASE WHEN x > 0.7 THEN 0.9 WHEN x > 0.5 THEN 0.75 WHEN x > 0.3 THEN 0.6 WHEN x > 0.1 THEN 0.5 ELSE 0.8 END + CASE WHEN kw = 0 THEN 0.2 ELSE 0 END), 4) AS confidence, coalesce(topics, '') AS topics
      FROM f LEFT JOIN tops USING ({_EVERY})""",
    "entity_types": """WITH r AS (SELECT 'ORG' AS label, name AS text, '' AS before FROM committees UNION ALL SELECT 'PERSON', name, CASE WHEN office = 'S' THEN 'said senator' ELSE 'said citizen' END FROM candidates
        UNION ALL SELECT DISTINCT 'GPE', state, 'in' FROM candidates)
      SELECT label, text, CASE WHEN label = 'ORG' AND regexp_matches(lower(text), 'party|committee|commission|congress') THEN 'political_org' WHEN label = 'PERSON' AND contains(before, 'senator') THEN 'politician' WHEN label = 'GPE' THEN 'jurisdiction' END AS political_type FROM r""",
    "contains_pii": f"""SELECT {_EVERY} FROM tweets WHERE regexp_matches(text_raw, '{_PII["EMAIL"]}') OR regexp_matches(text_raw, '(\\+?1[-.\\s]?)?\\(?\\d{{3}}\\)?[-.\\s]?\\d{{3}}[-.\\s]?\\d{{4}}')
      OR regexp_matches(text_raw, '\\b\\d{{3}}[-\\s]?\\d{{2}}[-\\s]?\\d{{4}}\\b') OR regexp_matches(text_raw, '\\b\\d{{4}}[-\\s]?\\d{{4}}[-\\s]?\\d{{4}}[-\\s]?\\d{{4}}\\b') OR regexp_matches(text_raw, '{_PII["IP_ADDRESS"]}')""",
    "pii_types": "SELECT pii_type, n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS pii_type, sum(len(regexp_extract_all(text_raw, '{v}')))::BIGINT AS n FROM tweets" for k, v in privacy.PATTERNS.items()) + ") WHERE n > 0",
    "redact_email_ip": f"SELECT {_EVERY}, regexp_replace(regexp_replace(text_raw, '{_PII['EMAIL']}', '[REDACTED]_EMAIL', 'g'), '{_PII['IP_ADDRESS']}', '[REDACTED]_IP_ADDRESS', 'g') AS text FROM tweets",
    "hash_authors": f"SELECT DISTINCT author_id_hash, 'uid_' || substr(sha256('{SALT}' || author_id_hash), 1, 16) AS uid, 'user_' || substr(md5('{SALT}' || author_id_hash), 1, 16) AS name FROM tweets",
    "pseudonym_rank": "SELECT author_id_hash, 'Person_' || lpad((row_number() OVER (ORDER BY f, author_id_hash))::VARCHAR, 4, '0') AS pseudonym FROM (SELECT author_id_hash, min(collected_at) AS f FROM tweets WHERE author_id_hash IS NOT NULL GROUP BY 1)",
    "anonymize_items": f"""SELECT {_EVERY}, 'uid_' || substr(sha256('{SALT}' || author_id_hash), 1, 16) AS author_id_hash, 'user_' || substr(sha256('{SALT}someone'), 1, 16) AS author_username_hash,
      array_to_string(list_transform(mentions, lambda x: 'user_' || substr(sha256('{SALT}' || regexp_replace(x, '^@+', '')), 1, 16)), ',') AS mentions_hashes FROM tweets""",
}
