"""One consistent form for text that looks the same (problem 1).

1. Count the characters of all texts (per batch first, so only the alphabet is shuffled).
2. Union-find over code points and strings joins everything that prints alike: seed pairs of
   letters, width and ligature rules, composed and decomposed accents.
3. Each class is written as its most frequent member (ties: shorter, then smaller code points).
4. A multi-pattern automaton rewrites greedily, longest match first from the left; zero-width
   characters vanish, but joiners inside emoji sequences stay, as they can be seen.

The table is bounded by Unicode, not by the corpus: one entry per code point that occurs.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorasift.llm.characters import LATIN_LIKE, MARK_LIKE, invisible, rule_equal
from agorasift.llm.groups import pairs_of_forms
from agorasift.session import cut

JOINERS = "‌‍"


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, s: str) -> str:
        self.up.setdefault(s, s)
        root = s
        while self.up[root] != root:
            root = self.up[root]
        while self.up[s] != root:
            self.up[s], s = root, self.up[s]
        return root

    def union(self, a: str, b: str) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.up[max(ra, rb)] = min(ra, rb)


def lookalike_table(counts: dict[str, int]) -> dict[str, str]:
    """pattern -> representative for the alphabet ``counts`` (character or base+mark string -> frequency)."""
    classes, alphabet = Classes(), {ch for s in counts for ch in s}
    for table in (LATIN_LIKE, MARK_LIKE):
        for base, others in table.items():
            for ch in others:
                classes.union(base, ch)
    alphabet |= set(classes.up)
    todo = list(alphabet)
    while todo:  # decompositions may bring further characters
        ch = todo.pop()
        equal = rule_equal(ch)
        if equal is not None and not invisible(ch):
            classes.union(ch, equal)
            for x in equal:
                if x not in alphabet:
                    alphabet.add(x)
                    todo.append(x)
    # base + mark strings: the base's look-alikes carry the mark as well
    for s in [s for s in counts if len(s) == 2 and unicodedata.combining(s[1])]:
        composed = unicodedata.normalize("NFC", s)
        classes.union(s, composed)
    members: dict[str, list[str]] = {}
    for s in list(classes.up):
        members.setdefault(classes.find(s), []).append(s)
    single = {s: m for m in members.values() for s in m}
    for s in list(single):
        if len(s) == 2 and unicodedata.combining(s[1]):
            for other in single.get(s[0], [s[0]]):
                if len(other) == 1:
                    classes.union(s, other + s[1])
    members = {}
    for s in classes.up:
        members.setdefault(classes.find(s), []).append(s)
    out = {}
    for group in members.values():
        best = min(group, key=lambda s: (-counts.get(s, 0), len(s), s))
        out.update({s: best for s in group if s != best})
    for ch in alphabet:
        if invisible(ch) and ch not in JOINERS:
            out[ch] = ""
    # a representative may itself hold characters that are rewritten; settle them, so the result is a fixed point
    for _ in range(len(out)):  # each turn settles one more link of a chain
        moved = False
        for s, r in list(out.items()):
            if r not in out and len(r) > 1:
                settled = "".join(out.get(x, x) for x in r)
                moved |= settled != r
                out[s] = settled
        if not moved:
            break
    return {s: r for s, r in out.items() if s != r}


class Rewriter:
    """Greedy longest-first rewriting by one multi-pattern automaton over all patterns of the table."""

    def __init__(self, table: dict[str, str]) -> None:
        self.table = table
        self.ascii_stays = not any(s.isascii() for s in table)

    @cached_property
    def automaton(self):  # noqa: ANN201  built where it is used, once per worker
        import ahocorasick

        a = ahocorasick.Automaton()
        for s, r in self.table.items():
            a.add_word(s, (len(s), r))
        a.make_automaton()
        return a

    def __getstate__(self) -> dict:
        return {"table": self.table, "ascii_stays": self.ascii_stays}

    @staticmethod
    def _joiner(m: re.Match) -> str:
        s, i = m.string, m.start()
        before, after = s[i - 1 : i], s[m.end() : m.end() + 1]
        pictures = before and after and unicodedata.category(before) in ("So", "Sk", "Mn") and unicodedata.category(after) == "So"
        return "\u200d" if pictures and "\u200d" in m.group() else ""

    def _once(self, text: str) -> str:
        out, at = [], 0
        for end, (n, r) in self.automaton.iter_long(text):
            out += (text[at : end + 1 - n], r)
            at = end + 1
        return "".join(out) + text[at:] if out else text

    def __call__(self, text: str) -> str:
        if not self.table or (self.ascii_stays and text.isascii()):
            return text
        if "\u200c" in text or "\u200d" in text:
            text = re.sub(f"[{JOINERS}]+", self._joiner, "".join(ch for ch in text if ch in JOINERS or self.table.get(ch) != ""))
        while (new := self._once(text)) != text:  # a removed character can bring a base and its mark together
            if len(new) == len(text) and self._once(new) == text:
                break  # cannot be with a settled table
            text = new
        return new


def _count_batch(texts: Iterable[str]) -> Counter:
    whole = "\n".join(texts)
    c = Counter(whole)
    c.update({t: n for t in STRINGS if (n := whole.count(t))})
    if not whole.isascii():
        c.update(m.group() for m in _MARKED.finditer(whole))
    return c


_MARKED = re.compile("[^\\W\\d_][\u0300-\u036f]")
#: Strings that some single character prints like (ligatures, digraphs, roman numerals).
STRINGS = sorted({t for c in range(0x3000) if (t := rule_equal(chr(c))) and len(t) > 1 and t.isascii()} | {rule_equal(chr(c)) for c in range(0xFB00, 0xFB07)})


def alphabet_counts(texts: DataFrame, column: str) -> dict[str, int]:
    """Frequency of every character, and of every letter with one combining mark, over all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()  # bounded by the alphabet
        for pdf in batches:
            total.update(_count_batch(pdf["t"].dropna()))
        yield pd.DataFrame(list(total.items()), columns=["s", "n"])

    rows = texts.select(F.col(column).alias("t")).mapInPandas(count, "s string, n long").groupBy("s").agg(F.sum("n").alias("n"))
    return {r["s"]: r["n"] for r in rows.collect()}  # one row per code point that occurs: bounded by Unicode


def rewrite(df: DataFrame, column: str, out: str, table: dict[str, str]) -> DataFrame:
    """``df`` with ``out`` = the consistent form of ``column``; null stays null, empty stays empty.

    Plain ASCII rows never leave the JVM when the table leaves ASCII alone.
    """
    rewriter = Rewriter(table)

    @F.pandas_udf(T.StringType())
    def norm(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else rewriter(x))

    norm = norm.asNondeterministic()  # else a filter on the result would run it twice
    if rewriter.ascii_stays:
        plain = F.col(column).rlike(r"^\p{ASCII}*$") | F.col(column).isNull()
        odd = F.when(~plain, F.col(column))  # null for plain rows, which the function then skips
        return df.withColumn(out, F.coalesce(norm(odd), F.col(column)))
    return df.withColumn(out, norm(F.col(column)))


def lookalike_pairs(rows: DataFrame, member: str, column: str, table: dict[str, str]) -> DataFrame:
    """Distinct (``member_a, member_b``) whose texts look the same but differ in characters.

    Every such pair has at least one text that the rewriting changes, so only changed texts and the
    rows equal to their consistent form are brought together. Null texts and members give no pair.
    """
    base = rows.select(F.col(member).alias("m"), F.col(column).alias("t")).where("m is not null and t is not null")
    changed = cut(rewrite(base, "t", "norm", table).where("norm <> t").distinct())
    forms = changed.select(F.col("norm").alias("t"), F.xxhash64("norm").alias("h")).distinct()
    plain = base.withColumn("h", F.xxhash64("t")).join(forms, ["h", "t"], "left_semi").select("m", "t", F.col("t").alias("norm"))
    both = changed.unionByName(plain).select(F.col("m").alias(member), F.col("t").alias("form"), "norm")
    return pairs_of_forms(both, "norm", "form", member)


def found(tweets: DataFrame) -> DataFrame:
    """``field, tweet_id_a, tweet_id_b`` for text_raw and hashtags."""
    texts = tweets.select("tweet_id", "text_raw")
    tags = tweets.select("tweet_id", F.explode("hashtags").alias("tag"))
    every = texts.select(F.col("text_raw").alias("t")).unionByName(tags.select(F.col("tag").alias("t")))
    table = lookalike_table(alphabet_counts(every, "t"))
    a = lookalike_pairs(texts, "tweet_id", "text_raw", table).select(F.lit("text_raw").alias("field"), "tweet_id_a", "tweet_id_b")
    b = lookalike_pairs(tags, "tweet_id", "tag", table).select(F.lit("hashtags").alias("field"), "tweet_id_a", "tweet_id_b")
    return a.unionByName(b)


def classes(tweets: DataFrame) -> DataFrame:
    """``tweet_id, form_md5, changed``: every distinct text of a tweet with the class of texts that look like it, named by its consistent form.

    Two texts look the same if and only if their ``form_md5`` are equal; no pair is written out. Null ids and texts give no row.
    """
    rows = tweets.where("tweet_id is not null and text_raw is not null").select("tweet_id", "text_raw")
    table = lookalike_table(alphabet_counts(rows, "text_raw"))
    forms = rewrite(rows, "text_raw", "form", table)
    return forms.select("tweet_id", F.md5("form").alias("form_md5"), (F.col("form") != F.col("text_raw")).alias("changed")).distinct()


def consistent_tags(tweets: DataFrame) -> DataFrame:
    """``tag, spellings, uses``: every visible hashtag in its consistent form."""
    tags = tweets.select(F.explode("hashtags").alias("tag")).where("tag is not null").groupBy("tag").agg(F.count("*").alias("n"))
    table = lookalike_table(alphabet_counts(tags, "tag"))
    return rewrite(tags, "tag", "form", table).groupBy(F.col("form").alias("tag")).agg(F.count("*").alias("spellings"), F.sum("n").alias("uses"))
