"""Entities from gazetteers, their political type, and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorasift.operators.keywords import match

# Organisations of government and titles of office.
GOVERNMENT = (
    "democratic party|republican party|gop|dnc|rnc|congress|senate|house of representatives|supreme court|white house|pentagon|fbi|cia|nsa|dhs|doj|fec|ftc|sec|epa|fda"
).split("|")
TITLES = (
    "president|vice president|senator|representative|congressman|congresswoman|governor|mayor|secretary|attorney general|speaker|leader|justice|judge|ambassador|commissioner"
).split("|")
# Weight of each political type in the entity score.
TYPE_WEIGHTS = {"politician": 2.0, "government_org": 1.5, "political_org": 1.5, "legislation": 2.0, "jurisdiction": 0.5, "political_event": 1.5, "political_group": 1.0}
LABELS = ("PERSON", "ORG", "GPE", "EVENT", "LAW", "NORP")


def recognize(df: DataFrame, gazetteer: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``entities``: whole-word gazetteer hits (text, label, start, end, before).

    ``gazetteer``: ``name, label``. ``before``: the three words in front, for title rules. Other
    recognisers fit in by giving the same array.
    """
    entries = gazetteer.select(F.col("name").alias("keyword"), F.col("label").alias("category"), F.lit(None).cast("string").alias("subcategory"), F.lit(1.0).alias("weight"))
    hits = match(df, entries, text, "_hits", whole_words=True)
    body = F.col(text)

    def entity(m: Column) -> Column:
        lead = F.array_join(F.slice(F.reverse(F.filter(F.split(F.substring(body, F.lit(1), m["start"]), r"\s+"), lambda w: w != "")), 1, 3), " ")
        return F.struct(m["keyword"].alias("text"), m["category"].alias("label"), m["start"].alias("start"), m["end"].alias("end"), lead.alias("before"))

    return hits.withColumn("entities", F.transform("_hits", entity)).drop("_hits")


def political_type(label: Column, text: Column, before: Column) -> Column:
    """Political type of an entity, null if it has none. ``before``: the words in front of it."""
    low, lead = F.lower(text), F.lower(before)
    def any_of(c: Column, words: list[str]) -> Column:
        return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))

    return (
        F.when((label == "ORG") & low.isin(*GOVERNMENT), "government_org")
        .when((label == "ORG") & any_of(low, ["party", "committee", "commission", "congress"]), "political_org")
        .when((label == "PERSON") & any_of(lead, TITLES), "politician")
        .when(label == "GPE", "jurisdiction")
        .when(label == "LAW", "legislation")
        .when(label == "NORP", "political_group")
        .when((label == "EVENT") & any_of(low, ["election", "debate", "summit", "hearing"]), "political_event")
    )


def with_types(entities: Column) -> Column:
    return F.transform(entities, lambda e: e.withField("political_type", political_type(e["label"], e["text"], e["before"])))


def political_only(entities: Column) -> Column:
    return F.filter(with_types(entities), lambda e: e["political_type"].isNotNull())


def entity_score(entities: Column, text: Column) -> Column:
    """Weights of the political entities per 1000 characters; other types weigh 1."""
    weights = F.create_map(*[F.lit(x) for kv in TYPE_WEIGHTS.items() for x in kv])
    total = F.aggregate(entities, F.lit(0.0), lambda a, e: a + F.coalesce(F.element_at(weights, F.coalesce(e["political_type"], F.lit("-"))), F.lit(1.0)))
    return total * 1000 / F.greatest(F.length(text), F.lit(1))


def summary(entities: Column) -> Column:
    """Counts, names by label and by political type (each once, in order)."""
    typed = with_types(entities)
    political = F.filter(typed, lambda e: e["political_type"].isNotNull())

    def names(xs: Column, field: str) -> Column:
        keys = F.array_distinct(F.transform(xs, lambda e: e[field]))
        return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.array_distinct(F.transform(F.filter(xs, lambda e: e[field] == k), lambda e: e["text"])).alias("value"))))

    return F.struct(
        F.size(typed).alias("total_entities"), F.size(political).alias("political_entities"), names(typed, "label").alias("by_label"), names(political, "political_type").alias("political_by_type"),
        F.array_distinct(F.transform(typed, lambda e: e["text"])).alias("unique_entities"), F.array_distinct(F.transform(political, lambda e: e["text"])).alias("unique_political"),
    )
