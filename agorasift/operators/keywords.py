"""Multi-pattern keyword matching with category weights.

A dictionary is a DataFrame ``keyword, category, subcategory, weight``. Matching is substring
matching: of all occurrences the one that ends first (of several, the longest) is taken, then the
search goes on behind it. The automaton is built once per Python worker and fed by Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The built-in dictionary; category -> (weight, keywords).
BUILT_IN = {
    "politicians": (2.0, "Biden Trump Obama Harris Pelosi McConnell Schumer McCarthy"),
    "parties": (1.5, "Democrat Republican GOP DNC RNC liberal conservative progressive"),
    "topics": (1.0, "election vote ballot campaign Congress Senate House policy legislation bill"),
}
#: Keywords that an automaton holds, about; larger dictionaries are matched in parts.
MOST = 1_000_000
MATCH = T.ArrayType(
    T.StructType().add("keyword", "string").add("category", "string").add("subcategory", "string").add("weight", "double").add("start", "integer").add("end", "integer")
)


def built_in(spark: SparkSession) -> DataFrame:
    rows = [(w.lower(), c, None, weight) for c, (weight, words) in BUILT_IN.items() for w in words.split()]
    return spark.createDataFrame(rows, "keyword string, category string, subcategory string, weight double")


def load_dictionaries(spark: SparkSession, path: str) -> DataFrame:
    """Dictionaries from JSON files: flat (keywords, subcategories by name) or nested (categories[].subcategories[]).

    A keyword of a subcategory replaces the plain one; of several files the one that sorts last wins.
    """
    raw = spark.read.option("wholetext", True).text(path).withColumn("_f", F.input_file_name())
    j = F.col("value")
    stem = F.regexp_extract("_f", r"([^/]+)\.json$", 1)
    flat = raw.select(
        "_f", F.coalesce(F.get_json_object(j, "$.category"), stem).alias("category"), F.coalesce(F.get_json_object(j, "$.weight").cast("double"), F.lit(1.0)).alias("weight"),
        F.from_json(F.get_json_object(j, "$.keywords"), "array<string>").alias("k"), F.from_json(F.get_json_object(j, "$.subcategories"), "map<string,array<string>>").alias("s"),
        F.from_json(F.get_json_object(j, "$.categories"), "array<struct<name:string,subcategories:array<struct<name:string,keywords:array<string>,weight:double>>>>").alias("n"),
    )
    none = F.lit(None).cast("string")
    plain = flat.select("_f", "category", none.alias("subcategory"), "weight", F.explode("k").alias("keyword"), F.lit(0).alias("_p"))
    subs = flat.select("_f", "category", "weight", F.explode("s").alias("subcategory", "ks")).select("_f", "category", "subcategory", "weight", F.explode("ks").alias("keyword"), F.lit(1).alias("_p"))
    nested = flat.select("_f", F.explode("n").alias("c")).select("_f", F.col("c.name").alias("category"), F.explode("c.subcategories").alias("x"))
    nested = nested.select("_f", "category", F.col("x.name").alias("subcategory"), F.coalesce("x.weight", F.lit(1.0)).alias("weight"), F.explode("x.keywords").alias("keyword"), F.lit(1).alias("_p"))
    return last_wins(plain.unionByName(subs).unionByName(nested), F.struct("_f", "_p"))


def last_wins(entries: DataFrame, order: Column) -> DataFrame:
    """One entry per lower-case keyword, the last in ``order``."""
    kept = entries.groupBy(F.lower("keyword").alias("keyword")).agg(F.max_by(F.struct("category", "subcategory", "weight"), order).alias("e"))
    return kept.select("keyword", "e.category", "e.subcategory", "e.weight")


def add_keywords(dictionary: DataFrame, words: list[str], category: str, subcategory: str | None = None, weight: float = 1.0) -> DataFrame:
    """``dictionary`` with further keywords, which replace equal ones; a category that is new comes into being."""
    new = dictionary.sparkSession.createDataFrame([(w.lower(), category, subcategory, float(weight)) for w in words], "keyword string, category string, subcategory string, weight double")
    both = dictionary.select("keyword", "category", "subcategory", "weight").withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    return last_wins(both, F.struct("_o", "weight", "category", "subcategory"))


class Automaton:
    """Earliest-end, then longest, non-overlapping matches."""

    def __init__(self, entries: list[tuple]) -> None:
        self.entries = {k: (c, s, w) for k, c, s, w in entries if k}
        try:
            import ahocorasick

            self.machine = ahocorasick.Automaton()
            for k in self.entries:
                self.machine.add_word(k, k)
            if self.entries:
                self.machine.make_automaton()
        except ImportError:
            self.machine = None
            self.trie: dict = {}
            for k in self.entries:
                node = self.trie
                for ch in k:
                    node = node.setdefault(ch, {})
                node[""] = k

    def occurrences(self, low: str) -> list[tuple[int, int, str]]:
        """(end, start, keyword) of all occurrences."""
        if not self.entries:
            return []
        if self.machine is not None:
            return [(e + 1, e + 1 - len(k), k) for e, k in self.machine.iter(low)]
        out = []
        for start in range(len(low)):
            node, at = self.trie, start
            while at < len(low) and (node := node.get(low[at])) is not None:
                at += 1
                if "" in node:
                    out.append((at, start, node[""]))
        return out

    def hits(self, text: str, whole_words: bool = False, case_sensitive: bool = False) -> list[dict]:
        """All occurrences, by end and then start."""
        low = text if case_sensitive else text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer would shift the places
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        out = []
        for end, start, k in sorted(self.occurrences(low)):
            if whole_words and ((start and low[start - 1].isalnum()) or (end < len(low) and low[end].isalnum())):
                continue
            c, s, w = self.entries[k]
            out.append({"keyword": text[start:end], "category": c, "subcategory": s, "weight": w, "start": start, "end": end})
        return out

    def match(self, text: str, whole_words: bool = False, case_sensitive: bool = False) -> list[dict]:
        return settled(self.hits(text, whole_words, case_sensitive))


def settled(hits: list[dict]) -> list[dict]:
    """The hits that stay: each begins behind the one before."""
    out, last = [], 0
    for h in hits:
        if h["start"] >= last:
            out.append(h)
            last = h["end"]
    return out


def match(df: DataFrame, dictionary: DataFrame, text: str = "text", out: str = "matches", whole_words: bool = False, case_sensitive: bool = False, most: int = MOST) -> DataFrame:
    """``df`` with the array ``out`` of matches in order; null text gives null, an empty dictionary no match.

    ``case_sensitive``: keywords count as they are written in the dictionary. A dictionary of more than
    ``most`` keywords is matched in parts, whose hits are then settled together.
    """
    word = F.col("keyword") if case_sensitive else F.lower("keyword")
    listed = dictionary.where("keyword is not null").select(word.alias("keyword"), "category", "subcategory", F.col("weight").cast("double").alias("weight"))
    parts = -(-listed.count() // most) or 1

    def finder(part: int):  # noqa: ANN202
        rows = listed.where(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == part).orderBy("keyword").collect()  # about ``most`` rows
        entries = [tuple(r) for r in rows]

        @F.pandas_udf(MATCH)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            machine = Automaton(entries)
            one = machine.match if parts == 1 else machine.hits
            for s in batches:
                yield s.map(lambda x: None if x is None else one(x, whole_words, case_sensitive))

        return find.asNondeterministic()  # else a filter on the matches, or exploding them, would run it again

    if parts == 1:
        return df.withColumn(out, finder(0)(F.col(text)))

    @F.pandas_udf(MATCH)
    def settle(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else settled(sorted(x, key=lambda h: (h["end"], h["start"]))))

    names = [f"_hits{i}" for i in range(parts)]
    for i, name in enumerate(names):
        df = df.withColumn(name, finder(i)(F.col(text)))
    return df.withColumn(out, settle(F.concat(*names))).drop(*names)


def with_context(matches: Column, text: Column, chars: int = 50) -> Column:
    """The matches with ``context``: up to ``chars`` characters on either side, ``...`` where text was cut."""
    def around(m: Column) -> Column:
        a, b = F.greatest(F.lit(0), m["start"] - chars), F.least(F.length(text), m["end"] + chars)
        body = F.substring(text, a + 1, b - a)
        return m.withField("context", F.concat(F.when(a > 0, "...").otherwise(""), body, F.when(b < F.length(text), "...").otherwise("")))

    return F.transform(matches, around)


def score(matches: Column, text: Column) -> Column:
    """Struct: total (weights per 1000 characters, 4 digits), count, keywords and weights by category."""
    weight = F.aggregate(matches, F.lit(0.0), lambda a, m: a + m["weight"])
    scale = 1000 / F.greatest(F.length(text), F.lit(1))
    categories = F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["category"])))
    raw = F.map_from_entries(F.transform(categories, lambda c: F.struct(c.alias("key"), F.aggregate(F.filter(matches, lambda m: m["category"] == c), F.lit(0.0), lambda a, m: a + m["weight"]).alias("value"))))
    return F.struct(
        F.round(weight * scale, 4).alias("total_score"), F.size(matches).alias("match_count"), weight.alias("weight"),
        F.array_sort(F.array_distinct(F.transform(matches, lambda m: F.lower(m["keyword"])))).alias("unique_keywords"),
        F.transform_values(raw, lambda _, v: v * scale).alias("category_scores"), raw.alias("raw_category_scores"),
    )


def dictionary_stats(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("category").agg(F.count_distinct("keyword").alias("keywords"), F.count_distinct("subcategory").alias("subcategories"), F.max("weight").alias("weight"))


def fold_matches(df: DataFrame, dictionary: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The same matches by Column functions alone (a cross-check for short texts): ``key, matches``.

    Candidates come from a join on the keyword's first three characters at every position.
    """
    low = F.lower(F.col(text))
    at = df.select(key, low.alias("_low"), F.posexplode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1))), lambda i: F.substring(low, i, 2))).alias("_at", "_two"))
    d = dictionary.select(F.lower("keyword").alias("_k"), "category", "weight")
    cand = at.join(d.withColumn("_two", F.substring("_k", 1, 2)), "_two").where(F.expr("substring(_low, _at + 1, length(_k))") == F.col("_k"))
    grouped = cand.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((F.col("_at") + F.length("_k")).alias("end"), F.col("_at").alias("start"), F.col("_k").alias("keyword"), "category", "weight"))).alias("c"))
    keep = F.aggregate("c", F.filter("c", lambda x: F.lit(False)), lambda acc, x: F.when((F.size(acc) == 0) | (x["start"] >= F.element_at(acc, -1)["end"]), F.concat(acc, F.array(x))).otherwise(acc))
    return grouped.select(key, keep.alias("matches"))
