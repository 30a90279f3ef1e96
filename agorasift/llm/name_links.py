"""Linking the spellings of one person's or organisation's name (problem 7).

1. Names are parsed to a form (words, initials, suffix); equal forms of one place are one class.
2. Every word of a form, common or not, is a key word inside its place. Only words are compared with
   words: a prefix-filtered set-similarity join on their 2-grams, inside one place, finds equal and misspelt words.
3. Classes with a similar key word are compared by soft weighted word similarity, rare words counting more.
4. Sure links are contracted to components. A class that may belong to several (an initial only, an
   ambiguous short form, no place) joins the only component it fits, and none if it fits several.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorasift.llm import names as N
from agorasift.llm.groups import pairs_of_forms
from agorasift.llm.components import components
from agorasift.session import cut, release

#: Similarity of the 2-gram sets of a word and its misspelling.
GRAMS = 0.4
SURE = 0.6


_PARSED = T.StructType().add("words", T.ArrayType(T.StringType())).add("initials", T.ArrayType(T.StringType())).add("suffix", "string").add("org", "boolean").add("family", T.ArrayType(T.StringType()))


@F.pandas_udf(_PARSED)
def _parsed(s: pd.Series) -> pd.DataFrame:
    rows = [N.parse(x or "") for x in s]
    return pd.DataFrame([(*r, [] if r[3] else N.families(r[0])) for r in rows], columns=["words", "initials", "suffix", "org", "family"])


def _place(c: Column) -> Column:
    text = F.upper(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))
    return F.when(text != "", text)


def classes_of(contributions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members ``contribution_id, name, cls``; classes ``cls, city, state, words, initials, suffix, org, family``); ``cls`` is a number."""
    rows = contributions.where("contribution_id is not null and contributor_name is not null").select(
        "contribution_id", F.col("contributor_name").alias("name"), _place(F.col("contributor_city")).alias("city"), _place(F.col("contributor_state")).alias("state")
    ).distinct()
    spelt = rows.select("name").distinct().withColumn("p", _parsed.asNondeterministic()("name"))  # run once, after the distinct
    spelt = spelt.select("name", "p.*").where(F.size("words") > 0)
    form = F.concat_ws("|", F.array_join("words", " "), F.array_join("initials", ""), "suffix", F.col("org").cast("string"))
    spelt = cut(spelt.withColumn("form", form))
    key = F.concat_ws("\x1f", "form", F.coalesce("city", F.lit("?")), F.coalesce("state", F.lit("?")))
    members = cut(rows.join(spelt, "name").select("contribution_id", "name", key.alias("key"), "city", "state", "words", "initials", "suffix", "org", "family"))
    parts = ["city", "state", "words", "initials", "suffix", "org", "family"]
    one = members.groupBy("key").agg(F.first(F.struct(*parts)).alias("c"))  # equal for equal keys
    cls = cut(one.select("key", "c.*").withColumn("cls", F.monotonically_increasing_id()))  # numbers stay as they are once stored
    return members.join(cls.select("key", "cls"), "key").select("contribution_id", "name", "cls"), cls.drop("key")


def key_words(cls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``cls, w``: the key words of each class; ``w, weight``: log of rarity of every word)."""
    words = cls.select("cls", F.explode(F.array_distinct("words")).alias("w"))
    total = cls.agg(F.count("*").alias("total"))
    df = words.groupBy("w").agg(F.count("*").alias("df"))
    df = df.join(F.broadcast(total)).select("w", F.log(1 + F.col("total") / F.col("df")).alias("weight"))  # one row
    return words.where(F.length("w") >= 2), df


def _grams(w: Column) -> Column:
    padded = F.concat(F.lit("^"), w, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, 2)))


def similar_words(words: DataFrame) -> DataFrame:
    """``k, wa, wb``: similar words inside one ``k`` of ``words`` (distinct ``k, w, asks``), wa being one that asks; wa = wb included.

    Prefix filter: two sets of 2-grams with a Jaccard similarity of at least ``GRAMS`` share one of
    their first |s| - ceil(GRAMS |s|) + 1 grams in one common order, rare grams first.
    """
    both = words.select("w").distinct().select("w", _grams(F.col("w")).alias("g"))
    freq = both.select(F.explode("g").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    ordered = (
        both.select("w", F.explode("g").alias("x")).join(freq, "x").groupBy("w").agg(F.array_sort(F.collect_list(F.struct("n", "x"))).alias("o"))
        .select("w", F.transform("o", lambda e: e["x"]).alias("o"))
    )
    size = F.size("o")
    prefix = cut(ordered.select("w", F.explode(F.slice("o", F.lit(1), size - F.ceil(size * GRAMS).cast("int") + 1)).alias("x")))
    every = words.join(prefix, "w")
    a, b = every.where("asks").select("k", "x", F.col("w").alias("wa")), every.select("k", "x", F.col("w").alias("wb"))
    near = a.join(b, ["k", "x"]).where("wa <> wb and abs(length(wa) - length(wb)) <= 2").select("k", "wa", "wb")
    lev = F.levenshtein("wa", "wb", 2)
    letters = lambda c: F.array_sort(F.split(c, ""))
    close = (lev == 1) | ((lev == 2) & ((letters("wa") == letters("wb")) | (F.least(F.length("wa"), F.length("wb")) >= 9)))
    same = words.where("asks").select("k", F.col("w").alias("wa"), F.col("w").alias("wb"))
    return near.where(close).distinct().unionByName(same)


def _near(x: Column, y: Column) -> Column:
    """Whatever :func:`names.typo` takes for slips, and a little more."""
    return (x == y) | (F.levenshtein(x, y, 4) <= F.when(F.least(F.length(x), F.length(y)) >= 9, 4).otherwise(2)) & (F.levenshtein(x, y, 4) >= 0)


#: Words that stand for a given name.
_GIVEN = sorted(N.FORMALS.keys() | N.SHORT_FORMS.keys())


def may_agree(a: str, b: str) -> Column:
    """What :func:`names.compare` asks of the forms in columns ``a`` and ``b`` in any case.

    All words of organisations must be near; persons of two words and more need a second word that is
    near, or a given name of one family, or one near a formal name. A given name that is near itself
    is no second word.
    """
    f = lambda s, x: F.col(s)[x]
    met = F.size(F.filter(f(a, "words"), lambda x: F.exists(f(b, "words"), lambda y: _near(x, y))))
    wide_a, wide_b = (F.concat(f(s, "words"), f(s, "family")) for s in (a, b))
    long = lambda c: F.filter(c, lambda x: F.length(x) > 4)
    alone = F.exists(f(a, "words"), lambda x: x.isin(*_GIVEN) & ~F.exists(f(b, "words"), lambda y: _near(x, y)))
    formal = (F.arrays_overlap(f(a, "family"), f(b, "family")) & alone) | F.exists(long(wide_a), lambda x: F.exists(F.filter(long(f(b, "family")), lambda y: y != x), lambda y: _near(x, y)))
    formal |= F.exists(long(wide_b), lambda x: F.exists(F.filter(long(f(a, "family")), lambda y: y != x), lambda y: _near(x, y)))
    short = F.least(F.size(f(a, "words")), F.size(f(b, "words"))) < 2
    same = (f(a, "org") == f(b, "org")) & (f(a, "suffix") == f(b, "suffix"))
    whole = (F.size(f(a, "words")) == F.size(f(b, "words"))) & (met == F.size(f(a, "words")))
    return same & F.when(f(a, "org"), whole).otherwise(short | (met >= 2) | formal)


def may_link(alike: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct ``a, b, k``: classes of ``left`` and ``right`` (``cls, w, k, f``) with an ``alike`` word that may be linked.

    Pairs of a common given name grow as the square of a place's classes; all but those that may
    agree end in the join.
    """
    a = left.select("k", F.col("w").alias("wa"), F.col("cls").alias("a"), "loose", F.col("f").alias("fa"))
    b = right.select("k", F.col("w").alias("wb"), F.col("cls").alias("b"), F.col("f").alias("fb"))
    met = alike.join(a, ["k", "wa"]).join(b, ["k", "wb"]).where("a <> b and fa.org = fb.org and fa.suffix = fb.suffix")
    return met.where(F.col("loose") | (F.col("a") < F.col("b"))).where(may_agree("fa", "fb")).select("a", "b", "k").distinct()


_OUT = T.StructType().add("a", "long").add("b", "long").add("k", "string").add("weak", "boolean")


@lru_cache(maxsize=100_000)
def _form(text: str) -> tuple[tuple, dict[str, float]]:
    """(parsed name, weights of its words) from the text that :func:`_told` makes."""
    words, initials, suffix, org = text.split("|")
    pairs = [w.split(":") for w in words.split()]
    return ([w for w, _ in pairs], list(initials), suffix, org == "true"), {w: float(x) for w, x in pairs}


def _told() -> Column:
    """Words with weights, initials, suffix and kind of a name as one text, which Python reads once per name."""
    words = F.array_join(F.transform("g", lambda e: F.concat_ws(":", e["w"], F.round(e["weight"], 5).cast("string"))), " ")
    return F.concat_ws("|", words, F.array_join("initials", ""), "suffix", F.col("org").cast("string"))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = []
        for a, b, k, ta, tb in zip(pdf["a"], pdf["b"], pdf["k"], pdf["ta"], pdf["tb"]):
            (pa, wa), (pb, wb) = _form(ta), _form(tb)
            weight = wa | wb
            keys = {(x, y) for x in pa[0] for y in pb[0] if len(x) >= 2 and (x == y or N.typo(x, y))}
            weak = [w for score, w in (N.compare(pa, pb, x, y, weight) for x, y in sorted(keys)) if score >= SURE]
            if weak:  # a given name as key hides that it is an ambiguous short form
                keep.append((a, b, k, any(weak)))
        yield pd.DataFrame(keep, columns=["a", "b", "k", "weak"])


#: Links of one place above which the place is contracted by joins and not in one task.
HOT_LINKS = 200_000


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Node and root of every component of the links of whole places."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                up[max(ra, rb)] = min(ra, rb)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "root": [find(x) for x in nodes]}, columns=["node", "root"], dtype="int64")


def place_components(links: DataFrame, hot_links: int = HOT_LINKS) -> DataFrame:
    """``node, root`` for links ``a, b`` that lie inside one place ``k`` each.

    Places are contracted where their links meet, many in a task; a place of more than ``hot_links``
    links is left to :func:`components`.
    """
    sizes = links.groupBy("k").agg(F.count("*").alias("n"))
    hot = cut(sizes.where(F.col("n") > hot_links).select("k"))
    if hot.isEmpty():
        return links.repartition("k").mapInPandas(_stars, "node long, root long")
    cold = links.join(hot, "k", "left_anti").repartition("k").mapInPandas(_stars, "node long, root long")
    return cold.unionByName(components(links.join(hot, "k", "left_semi").select("a", "b"))[0])


def linked_classes(cls: DataFrame, hot_links: int = HOT_LINKS) -> DataFrame:
    """``node, root`` for every class that is linked to another."""
    key, df = key_words(cls)
    place = cls.select("cls", "city", "state", F.struct("words", "suffix", "org", "family").alias("f")).join(key, "cls")
    full = F.col("city").isNotNull() & F.col("state").isNotNull()
    own = F.when(full, F.concat_ws("|", F.lit("cs"), "city", "state")).when(F.col("city").isNotNull(), F.concat_ws("|", F.lit("c"), "city")).when(F.col("state").isNotNull(), F.concat_ws("|", F.lit("s"), "state")).otherwise("*")
    left = cut(place.select("cls", "w", own.alias("k"), (~full).alias("loose"), "city", "state", "f"))
    # a class answers to its full place, and to places known in part
    every = F.array(F.when(full, F.concat_ws("|", F.lit("cs"), "city", "state")), F.when(F.col("city").isNotNull(), F.concat_ws("|", F.lit("c"), "city")), F.when(F.col("state").isNotNull(), F.concat_ws("|", F.lit("s"), "state")), F.lit("*"))
    asked = left.where("loose").select("k").distinct()
    wide = left.select("cls", "w", F.explode(every).alias("k"), F.col("k").alias("own"), "f").where("k is not null")
    right = cut(wide.where("k like 'cs|%'").unionByName(wide.where("k not like 'cs|%'").join(asked, "k", "left_semi")))
    alike = similar_words(cut(right.groupBy("k", "w").agg(F.max(F.col("k") == F.col("own")).alias("asks"))))
    release(cls.sparkSession)
    # a class's words and their weights
    weights = cls.select("cls", F.posexplode("words").alias("i", "w")).join(df, "w").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("i", "w", "weight"))).alias("g"))
    form = cut(cls.join(weights, "cls").select("cls", _told().alias("t")))
    pairs = may_link(alike, left, right)
    pairs = (
        pairs.join(form.select(F.col("cls").alias("a"), F.col("t").alias("ta")), "a")
        .join(form.select(F.col("cls").alias("b"), F.col("t").alias("tb")), "b")
        .select("a", "b", "k", "ta", "tb")
    )
    links = pairs.mapInPandas(_verify, _OUT)
    several = sorted(w for w, formal in N.FORMALS.items() if len(formal) > 1 and w not in N.SHORT_FORMS)
    short = (F.size("words") < 2) | F.exists("words", lambda w: w.isin(*several))
    vague = cls.select("cls", (F.col("city").isNull() | F.col("state").isNull()).alias("loose"), (short & ~F.col("org")).alias("short"))
    sides = cut(links.join(vague.select(F.col("cls").alias("a"), F.col("loose").alias("la"), F.col("short").alias("sa")), "a").join(vague.select(F.col("cls").alias("b"), F.col("loose").alias("lb"), F.col("short").alias("sb")), "b"))
    release(cls.sparkSession)
    first = cut(place_components(sides.where("not weak and not la and not lb").select("a", "b", "k"), hot_links))
    # classes that are vague by themselves, or linked by an ambiguous short form, choose among components
    unsure = sides.where("weak or la or lb")
    arms = unsure.select(F.col("a").alias("u"), F.col("b").alias("v"), (F.col("sa") | F.col("la")).alias("vu"), (F.col("sb") | F.col("lb")).alias("vv"))
    arms = arms.unionByName(unsure.select(F.col("b").alias("u"), F.col("a").alias("v"), (F.col("sb") | F.col("lb")).alias("vu"), (F.col("sa") | F.col("la")).alias("vv")))
    arms = arms.distinct().join(first.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left").join(first.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left")
    arms = cut(arms.select("u", "v", "vu", "vv", F.coalesce("ru", "u").alias("ru"), F.coalesce("rv", "v").alias("rv")))
    to_firm = cut(arms.where("not vv and ru <> rv").groupBy("u", "ru", "vu").agg(F.count_distinct("rv").alias("n"), F.min("rv").alias("rv")))
    chosen = to_firm.where("n = 1").select(F.col("ru").alias("a"), F.col("rv").alias("b"))
    # vague classes that fit no firm one may fit each other
    lost = arms.where("vu and vv").join(to_firm.select("u").distinct(), "u", "left_anti")
    lost = lost.join(to_firm.select(F.col("u").alias("v")).distinct(), "v", "left_anti").select(F.col("ru").alias("a"), F.col("rv").alias("b"))
    # components of components: only the new links are contracted
    above, _ = components(chosen.unionByName(lost))
    nodes = first.unionByName(above.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
    return nodes.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def linked_contributions(contributions: DataFrame) -> DataFrame:
    """``contribution_id, contributor_name, entity``: one row per contribution and spelling.

    Rows without id or name, and names without a word, are left out; repeated rows count once.
    """
    members, cls = classes_of(contributions)
    release(contributions.sparkSession)
    nodes = linked_classes(cls)
    return members.join(nodes.withColumnRenamed("node", "cls"), "cls", "left").select("contribution_id", F.col("name").alias("contributor_name"), F.coalesce("root", "cls").alias("entity"))


def found(contributions: DataFrame) -> DataFrame:
    """``contribution_id_a, contribution_id_b``: contributions of one entity under different spellings."""
    return pairs_of_forms(linked_contributions(contributions), "entity", "contributor_name", "contribution_id")
