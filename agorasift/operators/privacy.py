"""Detection of personal data by fixed patterns, salted hashing and anonymised records."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns of each kind, in the order in which they are tried.
PATTERNS = {
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "PHONE": r"(\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}",
    "SSN": r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b",
    "CREDIT_CARD": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
CONFIDENCE = 0.9
_SPAN = T.ArrayType(T.StructType().add("pii_type", "string").add("text", "string").add("start", "integer").add("end", "integer").add("confidence", "double"))
_COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}


def spans_in(text: str) -> list[tuple[str, str, int, int, float]]:
    """All hits by (start, falling confidence); one per identical span, overlaps stay."""
    hits = [(k, m.group(), m.start(), m.end(), CONFIDENCE) for k, p in _COMPILED.items() for m in p.finditer(text)]
    seen, out = set(), []
    for h in sorted(hits, key=lambda h: (h[2], -h[4])):
        if h[2:4] not in seen:
            seen.add(h[2:4])
            out.append(h)
    return out


def settle(spans: list[tuple], overlap: str) -> list[tuple]:
    """``merge``: of overlapping spans the longest, stretched over all of them; ``keep``: as they are."""
    if overlap == "keep":
        return spans
    out: list[list] = []
    for k, t, s, e, c in spans:
        if out and s < out[-1][3]:
            o = out[-1]
            if e - s > o[5]:
                o[0], o[5] = k, e - s
            o[3] = max(o[3], e)
        else:
            out.append([k, t, s, e, c, e - s])
    return [tuple(x[:5]) for x in out]


def detect(df: DataFrame, text: str = "text", overlap: str = "keep") -> DataFrame:
    """``df`` with ``pii``: array of (pii_type, text, start, end, confidence); null text gives null."""

    @F.pandas_udf(_SPAN)
    def find(s: pd.Series) -> pd.Series:
        names = ("pii_type", "text", "start", "end", "confidence")
        return s.map(lambda x: None if x is None else [dict(zip(names, (k, x[a:b], a, b, c))) for k, _, a, b, c in settle(spans_in(x), overlap)])

    return df.withColumn("pii", find.asNondeterministic()(F.col(text)))  # else exploding the spans would run it again


def contains_pii(c: Column) -> Column:
    hit = F.lit(False)
    for p in PATTERNS.values():
        hit = hit | c.rlike("(?U)" + p)
    return hit


def redact(df: DataFrame, text: str = "text", placeholder: str = "[REDACTED]", mention: str | None = "@[USER]", overlap: str = "merge") -> DataFrame:
    """``df`` with ``redacted`` (text) and ``pii_types`` (sorted kinds found).

    ``overlap='merge'`` leaves no rest of overlapping hits in the text; ``'keep'`` splices every hit from
    the right, as it is found. Mentions are replaced as whole words.
    """

    def splice(x: str) -> tuple[str, list[str]]:
        spans = settle(spans_in(x), overlap)
        for k, _, a, b, _ in sorted(spans, key=lambda h: -h[2]):
            x = f"{x[:a]}{placeholder}_{k}{x[b:]}"
        if mention is not None:
            x = re.sub(r"@\w+", mention.replace("\\", r"\\"), x)
        return x, sorted({h[0] for h in spans})

    kind = T.StructType().add("redacted", "string").add("pii_types", T.ArrayType(T.StringType()))

    @F.pandas_udf(kind)
    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([(None, None) if x is None else splice(x) for x in s], columns=["redacted", "pii_types"])

    return df.withColumn("_r", work(F.col(text))).select("*", "_r.redacted", "_r.pii_types").drop("_r")


def redact_column(c: Column, kinds: tuple[str, ...] = ("EMAIL", "IP_ADDRESS"), placeholder: str = "[REDACTED]") -> Column:
    """Kinds that cannot overlap, replaced without leaving the JVM."""
    for k in kinds:
        c = F.regexp_replace(c, PATTERNS[k], f"{placeholder}_{k}")
    return c


def hash_value(value: Column, salt: str, algorithm: str = "sha256", length: int | None = 16) -> Column:
    """Hexadecimal digest of salt + value, cut to ``length`` digits; the salt must be given."""
    if not salt:
        raise ValueError("an explicit salt is needed")
    salted = F.concat(F.lit(salt), value.cast("string"))
    digests = {"sha256": lambda: F.sha2(salted, 256), "sha512": lambda: F.sha2(salted, 512), "md5": lambda: F.md5(salted)}
    if algorithm not in digests:
        raise ValueError(f"unknown hash algorithm: {algorithm}")
    digest = digests[algorithm]()
    return F.substring(digest, 1, length) if length else digest


def hash_username(c: Column, salt: str, **kw: object) -> Column:
    return F.concat(F.lit("user_"), hash_value(F.regexp_replace(c, "^@+", ""), salt, **kw))


def hash_user_id(c: Column, salt: str, **kw: object) -> Column:
    return F.concat(F.lit("uid_"), hash_value(c, salt, **kw))


def pseudonyms(df: DataFrame, column: str, order: str) -> DataFrame:
    """``column, pseudonym``: ``Person_0001`` and so on, in the order of first appearance.

    The ranks are built in two steps (inside ranges of the order, then over range sizes), so no
    single task sorts all persons.
    """
    first = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    ranged = first.repartitionByRange("_first", column).withColumn("_part", F.spark_partition_id()).sortWithinPartitions("_first", column)
    from agorasift.session import cut

    ranged = cut(ranged)  # the partition numbers must not change between the two uses
    from pyspark.sql import Window

    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    base = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_first", column)) + F.col("_base")
    return ranged.join(F.broadcast(base), "_part").select(column, F.format_string("Person_%04d", rank).alias("pseudonym"))


def anonymize_items(df: DataFrame, salt: str, text: str | None = "text") -> DataFrame:
    """Records without direct identifiers: ids and names hashed, display names dropped, text redacted.

    Works on whatever of ``author_id, author_username, author_name, in_reply_to_user_id, mentions`` is there.
    """
    out, have = df, set(df.columns)
    if text in have:
        out = redact(out, text).drop(text, "pii_types").withColumnRenamed("redacted", text)
    if "author_id" in have:
        out = out.withColumn("author_id_hash", hash_user_id(F.col("author_id"), salt)).drop("author_id")
    if "author_username" in have:
        out = out.withColumn("author_username_hash", hash_username(F.col("author_username"), salt)).drop("author_username")
    if "in_reply_to_user_id" in have:
        out = out.withColumn("in_reply_to_user_id_hash", hash_user_id(F.col("in_reply_to_user_id"), salt)).drop("in_reply_to_user_id")
    if "mentions" in have:
        out = out.withColumn("mentions_hashes", F.transform("mentions", lambda m: hash_username(m, salt))).drop("mentions")
    return out.drop("author_name")
