"""Text cleaning as one chain of Column expressions; Python only where Spark has no function."""

from __future__ import annotations

import html
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a link, a mention, a tag, a run of emoji, repeated marks and a forward.
URL = r"""(?U)https?://[^\s<>"{}|\\^`\[\]]+|www\.[^\s<>"{}|\\^`\[\]]+"""
MENTION = r"(?U)@\w+"
HASHTAG = r"(?U)#(\w+)"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}"
    r"\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)
REPEATED = r"([!?.]){2,}"
FORWARD = r"(?iU)^RT\s*@\w+:\s*"


@dataclass(frozen=True)
class CleanConfig:
    """Switches of the cleaner; the defaults keep mentions, emoji and case."""

    remove_urls: bool = True
    remove_mentions: bool = False
    normalize_hashtags: bool = True
    remove_emojis: bool = False
    remove_retweet_prefix: bool = True
    lowercase: bool = False
    normalize_whitespace: bool = True
    normalize_unicode: bool = True
    unescape_html: bool = True
    detect_language: bool = True
    min_length: int = 1
    max_length: int | None = None


DEFAULT = CleanConfig(min_length=10)


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def _where(needed: Column, function, c: Column) -> Column:  # noqa: ANN001
    """``function(c)`` for the rows that need it; the others stay in the JVM.

    The function counts as nondeterministic, or filters on what is made of its result would run it again.
    """
    return F.coalesce(function.asNondeterministic()(F.when(needed, c)), c)


def unescape_html(c: Column) -> Column:
    return _where(F.contains(c, F.lit("&")), _unescape, c)


def normalize_unicode(c: Column) -> Column:
    return _where(~c.rlike(r"^\p{ASCII}*$"), _nfkc, c)


def strip_forward(c: Column) -> Column:
    return F.regexp_replace(c, FORWARD, "")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, " ")


def strip_mentions(c: Column) -> Column:
    return F.regexp_replace(c, MENTION, " ")


def plain_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, HASHTAG, "$1")


def strip_emoji(c: Column) -> Column:
    return F.regexp_replace(c, EMOJI, " ")


def count_emoji(c: Column) -> Column:
    """Runs of emoji, not single ones."""
    return F.regexp_count(c, F.lit(EMOJI))


def squeeze_marks(c: Column) -> Column:
    """A run of ``!?.`` becomes its last mark."""
    return F.regexp_replace(c, REPEATED, "$1")


def squeeze_space(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def extract_urls(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(URL), F.lit(0))


def extract_mentions(c: Column, keep_sign: bool = False) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(?U)@(\w+)"), F.lit(0 if keep_sign else 1))


def extract_hashtags(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(HASHTAG), F.lit(1))


def hashtag_words(tag: Column) -> Column:
    """``#ClimateChange`` and ``#climate_change`` -> ``climate change``; every capital starts a word."""
    spaced = F.regexp_replace(F.regexp_replace(tag, "^#+", ""), "([A-Z])", " $1")
    return F.lower(squeeze_space(F.regexp_replace(spaced, "_", " ")))


# Frequent function words of the languages that can be told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that for with this was on are be as by not but have from", "de": "der die das und ist nicht ein eine mit von zu den auf für im dem sich des wird bei",
    "fr": "le la les des et est une pas que dans pour qui sur au avec par du ce sont été", "es": "el la los las de y que en un una por con para del se no es al sobre ha",
}
# Scripts that name a language here, as character ranges.
SCRIPTS = {"ru": r"[\x{0400}-\x{04FF}]", "ar": r"[\x{0600}-\x{06FF}]", "hi": r"[\x{0900}-\x{097F}]", "th": r"[\x{0E00}-\x{0E7F}]", "ja": r"[\x{3040}-\x{30FF}]", "zh": r"[\x{4E00}-\x{9FFF}]"}


def guess_language(c: Column, min_chars: int = 20) -> Column:
    """Language by script, else by function words; null below ``min_chars`` or without any evidence.

    Deterministic; ties go to the language listed first. Other detectors fit in as any Column.
    """
    def guess(t: Column) -> Column:
        letters = F.greatest(F.regexp_count(t, F.lit(r"\p{L}")), F.lit(1))
        by_script = None
        for lang, chars in SCRIPTS.items():
            enough = F.regexp_count(t, F.lit(chars)) * 5 > letters
            by_script = F.when(enough, lang) if by_script is None else by_script.when(enough, lang)
        low = F.lower(t)
        scores = F.array(*[F.regexp_count(low, F.lit(rf"(?U)\b(?:{'|'.join(v.split())})\b")) for v in FUNCTION_WORDS.values()])
        best = _bound(scores, lambda x: F.when(F.array_max(x) > 0, F.element_at(F.array(*map(F.lit, FUNCTION_WORDS)), F.array_position(x, F.array_max(x)).cast("int"))))
        return F.when(F.length(t) >= min_chars, F.coalesce(by_script, best))

    return _bound(c, guess)


def _bound(c: Column, body) -> Column:  # noqa: ANN001
    """``body(c)`` with ``c`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(c), body), 1)


def clean(df: DataFrame, text: str = "text", cfg: CleanConfig = DEFAULT) -> DataFrame:
    """``df`` with the struct ``cleaning``: the cleaned text, its language, what was taken out, lengths.

    The stages run in a fixed order: unescape, width, forward prefix, links, mentions, tags, emoji, repeated
    marks, white space, case, length. Null text gives nulls, empty text stays empty.
    """
    c = F.col("_t")
    out = df.withColumn("_t", F.col(text))
    if cfg.unescape_html:
        out = out.withColumn("_t", unescape_html(c))
    if cfg.normalize_unicode:
        out = out.withColumn("_t", normalize_unicode(c))
    if cfg.remove_retweet_prefix:
        out = out.withColumn("_t", strip_forward(c))
    out = out.withColumn("_urls", extract_urls(c) if cfg.remove_urls else F.array().cast("array<string>"))
    if cfg.remove_urls:
        out = out.withColumn("_t", strip_urls(c))
    out = out.withColumn("_mentions", extract_mentions(c, keep_sign=True))
    if cfg.remove_mentions:
        out = out.withColumn("_t", strip_mentions(c))
    out = out.withColumn("_tags", extract_hashtags(c) if cfg.normalize_hashtags else F.array().cast("array<string>"))
    if cfg.normalize_hashtags:
        out = out.withColumn("_t", plain_hashtags(c))
    out = out.withColumn("_emoji", count_emoji(c))
    last = strip_emoji(c) if cfg.remove_emojis else c
    last = squeeze_marks(last)
    if cfg.normalize_whitespace:
        last = squeeze_space(last)
    if cfg.lowercase:
        last = F.lower(last)
    if cfg.max_length:
        last = F.substring(last, 1, cfg.max_length)
    out = out.withColumn("_t", last)
    lang = guess_language(c) if cfg.detect_language else F.lit(None).cast("string")
    result = F.struct(
        F.col(text).alias("original"), c.alias("cleaned"), lang.alias("language"), F.col("_urls").alias("removed_urls"),
        (F.col("_mentions") if cfg.remove_mentions else F.array().cast("array<string>")).alias("removed_mentions"),
        F.col("_tags").alias("hashtags"), F.col("_emoji").alias("emoji_count"),
        F.struct(F.length(text).alias("original_length"), F.length(c).alias("cleaned_length"), F.size("_mentions").alias("mentions_found")).alias("metadata"),
    )
    return out.withColumn("cleaning", result).drop("_t", "_urls", "_mentions", "_tags", "_emoji")


def keep_clean(df: DataFrame, text: str = "text", language: str = "en", cfg: CleanConfig = DEFAULT) -> DataFrame:
    """The cleaning job: drop empty texts, clean, keep the wanted language (``all``: any) and length.

    With a language named, texts too short to tell their language drop out.
    """
    rows = clean(df.where(F.col(text).isNotNull() & (F.col(text) != "")), text, cfg)
    if language != "all":
        rows = rows.where(F.col("cleaning.language") == language)
    return rows.where(F.length("cleaning.cleaned") >= cfg.min_length)


def of_language(df: DataFrame, language: str, column: str = "lang") -> DataFrame:
    """Rows whose stated language is ``language`` (``all``: every row)."""
    return df if language == "all" else df.where(F.col(column) == language)


def number_stats(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """``n, least, most, mean`` of a numeric column; null and NaN do not count."""
    v = F.col(column).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.round(F.avg(v), digits).alias("mean"))


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """``items, min_length, max_length, avg_length`` of the non-null texts."""
    n = F.length(text)
    return df.agg(F.count("*").alias("items"), F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.round(F.avg(n), 4).alias("avg_length"))


def histogram(df: DataFrame, column: str, top: int | None = None, missing: str = "unknown") -> DataFrame:
    """``value, n, percent``, most frequent first; null counts as ``missing``; ``top`` is a top-k report."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_all"))
    rows = counts.join(F.broadcast(total)).select("value", "n", F.round(100 * F.col("n") / F.col("_all"), 4).alias("percent"))  # one row
    rows = rows.orderBy(F.desc("n"), "value")
    return rows.limit(top) if top else rows
