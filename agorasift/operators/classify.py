"""Political relevance from keyword and entity scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorasift.operators import entities as E
from agorasift.operators import keywords as K


def combined_score(keyword: Column, entity: Column, keyword_weight: float = 0.6, entity_weight: float = 0.4) -> Column:
    """0 to 1; the keyword score comes in rounded."""
    return F.least(F.lit(1.0), (keyword * keyword_weight + entity * entity_weight) / 10)


def confidence(combined: Column, keyword: Column, entity: Column) -> Column:
    base = F.when(combined > 0.7, 0.9).when(combined > 0.5, 0.75).when(combined > 0.3, 0.6).when(combined > 0.1, 0.5).otherwise(0.8)
    both = ((keyword > 0) & (entity > 0)) | ((keyword == 0) & (entity == 0))
    return F.round(F.least(F.lit(1.0), base + F.when(both, 0.2).otherwise(0.0)), 4)


def topics(matches: Column) -> Column:
    """Sorted categories and subcategories."""
    both = F.concat(F.transform(matches, lambda m: m["category"]), F.filter(F.transform(matches, lambda m: m["subcategory"]), lambda s: s.isNotNull()))
    return F.array_sort(F.array_distinct(both))


def classify(df: DataFrame, dictionary: DataFrame, gazetteer: DataFrame | None = None, text: str = "text", min_score: float = 0.3) -> DataFrame:
    """``df`` with ``matches, entities`` and the struct ``political`` (is_political, score, confidence, topics, parts).

    ``is_political`` compares the exact score, ``score`` is rounded to 4 digits.
    """
    rows = K.match(df, dictionary, text)
    if gazetteer is not None:
        rows = E.recognize(rows, gazetteer, text)
    else:
        rows = rows.withColumn("entities", F.array().cast("array<struct<text:string,label:string,start:int,end:int,before:string>>"))
    body = F.col(text)
    rows = rows.withColumn("_kw", K.score(F.col("matches"), body)["total_score"]).withColumn("_ent", E.entity_score(E.political_only(F.col("entities")), body))
    rows = rows.withColumn("_all", combined_score(F.col("_kw"), F.col("_ent")))
    result = F.struct(
        (F.col("_all") >= min_score).alias("is_political"), F.round("_all", 4).alias("score"), confidence(F.col("_all"), F.col("_kw"), F.col("_ent")).alias("confidence"),
        topics(F.col("matches")).alias("topics"), F.col("_kw").alias("keyword_score"), F.round("_ent", 4).alias("entity_score"),
    )
    return rows.withColumn("political", result).drop("_kw", "_ent", "_all")


def political_only(df: DataFrame, min_score: float = 0.3) -> DataFrame:
    """Rows whose rounded score reaches ``min_score``."""
    return df.where(F.col("political.score") >= min_score)


def detect(df: DataFrame, dictionary: DataFrame, text: str = "text", min_score: float = 0.3) -> DataFrame:
    """The detection job: rows whose keyword score (per 1000 characters) reaches ``min_score``."""
    rows = K.match(df, dictionary, text).withColumn("score", K.score(F.col("matches"), F.col(text)))
    return rows.where(F.col("score.total_score") >= min_score).withColumn("categories", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["category"]))))
