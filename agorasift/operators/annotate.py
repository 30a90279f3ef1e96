"""Gold labels, pairwise agreement and statistics of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorasift.functions.labels import canonical

# Numeric value of each label; UNKNOWN has none.
LEANING = {"FAR_LEFT": -2.0, "LEFT": -1.0, "CENTER_LEFT": -0.5, "CENTER": 0.0, "CENTER_RIGHT": 0.5, "RIGHT": 1.0, "FAR_RIGHT": 2.0}
SENTIMENT = {"VERY_NEGATIVE": -2.0, "NEGATIVE": -1.0, "NEUTRAL": 0.0, "POSITIVE": 1.0, "VERY_POSITIVE": 2.0}


def _value(c: Column, table: dict[str, float]) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def normalized(annotations: DataFrame) -> DataFrame:
    """Labels in canonical spelling; odd labels become null, UNKNOWN stays a label of its own."""
    lean, sent = canonical(F.col("political_leaning")), canonical(F.col("sentiment"))
    return annotations.withColumn("political_leaning", F.when(lean.isin("UNKNOWN", *LEANING), lean)).withColumn("sentiment", F.when(sent.isin(*SENTIMENT), sent))


def _mode(rows: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value per item; ties go to the one seen first (least seq)."""
    counts = rows.where(F.col(column).isNotNull()).groupBy("item_id", column).agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return counts.groupBy("item_id").agg(F.max_by(column, F.struct("n", -F.col("first"))).alias(column))


def majority(annotations: DataFrame) -> DataFrame:
    """``item_id, political_leaning, sentiment, is_political, topics, annotation_count``."""
    rows = normalized(annotations).where("item_id is not null")
    out = rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("topics", F.array().cast("array<string>")))))).alias("topics"), F.count("*").alias("annotation_count"))
    for column in ("political_leaning", "sentiment", "is_political"):
        out = out.join(_mode(rows, column), "item_id", "left")
    return out.select("item_id", "political_leaning", "sentiment", "is_political", "topics", "annotation_count")


def weighted(annotations: DataFrame) -> DataFrame:
    """Confidence-weighted means; UNKNOWN and null labels are left out, a null confidence counts as 1."""
    rows = normalized(annotations).where("item_id is not null").withColumn("w", F.coalesce("confidence", F.lit(1.0)))

    def mean(v: Column) -> Column:
        return F.try_divide(F.sum(v * F.col("w")), F.sum(F.when(v.isNotNull(), F.col("w"))))

    share = mean(F.col("is_political").cast("double"))
    return rows.groupBy("item_id").agg(
        mean(_value(F.col("political_leaning"), LEANING)).alias("political_leaning"), mean(_value(F.col("sentiment"), SENTIMENT)).alias("sentiment"),
        (share >= 0.5).alias("is_political"), F.count("*").alias("annotation_count"),
    )


def average(annotations: DataFrame) -> DataFrame:
    rows = normalized(annotations).where("item_id is not null")
    return rows.groupBy("item_id").agg(
        F.avg(_value(F.col("political_leaning"), LEANING)).alias("political_leaning"), F.avg(_value(F.col("sentiment"), SENTIMENT)).alias("sentiment"), F.count("*").alias("annotation_count")
    )


def gold(annotations: DataFrame, method: str = "majority") -> DataFrame:
    methods = {"majority": majority, "weighted": weighted, "average": average}
    if method not in methods:
        raise ValueError(f"unknown method: {method}")
    return methods[method](annotations)


def agreement(annotations: DataFrame, annotators: list[str] | None = None) -> DataFrame:
    """One row: items with several annotations, share of agreeing pairs for leaning and is_political, leaning pairs.

    In closed form from counts per item and label; no pair is formed. UNKNOWN is a label here.
    """
    rows = normalized(annotations).where("item_id is not null")
    if annotators:
        rows = rows.where(F.col("annotator_id").isin(*annotators))
    several = rows.groupBy("item_id").agg(F.count("*").alias("c")).where("c >= 2").select("item_id")
    rows = rows.join(several, "item_id", "left_semi")

    def pairs(column: str, name: str) -> DataFrame:
        cells = rows.where(F.col(column).isNotNull()).groupBy("item_id", column).agg(F.count("*").alias("n"))
        items = cells.groupBy("item_id").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("same"), F.sum("n").alias("t"))
        return items.agg((F.coalesce(F.sum("same"), F.lit(0)) / 2).cast("long").alias(f"{name}_same"), (F.coalesce(F.sum(F.col("t") * (F.col("t") - 1)), F.lit(0)) / 2).cast("long").alias(f"{name}_pairs"))

    one = several.agg(F.count("*").alias("items_with_multiple_annotations"))
    joined = one.join(F.broadcast(pairs("political_leaning", "l"))).join(F.broadcast(pairs("is_political", "p")))  # one row each
    return joined.select(
        "items_with_multiple_annotations", F.try_divide(F.col("l_same"), F.col("l_pairs")).alias("political_leaning_agreement"),
        F.try_divide(F.col("p_same"), F.col("p_pairs")).alias("is_political_agreement"), F.col("l_pairs").alias("total_annotation_pairs"),
    )


def annotation_stats(annotations: DataFrame) -> DataFrame:
    return annotations.agg(
        F.count_distinct("item_id").alias("items"), F.count("*").alias("annotations"), F.count_distinct("annotator_id").alias("annotators"), F.round(F.try_divide(F.count("*"), F.count_distinct("item_id")), 4).alias("per_item")
    )


def with_seq(annotations: DataFrame, order: str = "created_at") -> DataFrame:
    """Adds ``seq`` within each item where a source gives none; only its order within an item matters."""
    return annotations.withColumn("seq", F.row_number().over(Window.partitionBy("item_id").orderBy(order, "annotator_id")).cast("long"))
