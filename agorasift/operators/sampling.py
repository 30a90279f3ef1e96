"""Balancing, splitting, sampling and merging, deterministic by hash rank.

Membership follows md5(seed | id), so a result depends on seed and ids alone, not on partitions.
Ranks within a hot class are taken in two steps where the wanted number is known beforehand.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def rank_key(seed: int, *columns: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def class_sizes(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("class")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "class")


def first_n(df: DataFrame, group: list[str], order: list[Column], n: int | Column, id_col: str) -> DataFrame:
    """The first ``n`` rows of each group; hot groups are trimmed per salt before they meet when n is a number."""
    if isinstance(n, int):
        w = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS))).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r", "_salt")
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def by_class(df: DataFrame, column: str, id_col: str, *, per_class: int | None = None, strategy: str = "undersample", seed: int = 42) -> DataFrame:
    """Equal numbers per class of ``column`` (a list counts in each of its classes); adds ``class`` and ``draw``.

    ``per_class`` defaults to the smallest class. ``undersample`` takes at most that many of each class.
    ``oversample`` draws with replacement where a class is too small: draw i of a class takes the row of
    rank hash(seed, class, i) modulo the class size. Null classes drop out.
    """
    if strategy not in ("undersample", "oversample"):
        raise ValueError(f"unknown strategy: {strategy}")
    listed = dict(df.dtypes)[column].startswith("array")
    rows = df.withColumn("class", F.explode(F.array_distinct(column)) if listed else F.col(column)).where("class is not null").withColumn("class", F.col("class").cast("string"))
    sizes = rows.groupBy("class").agg(F.count("*").alias("_n"))
    if per_class is None:
        smallest = sizes.agg(F.min("_n")).first()[0]
        if smallest is None:
            return rows.withColumn("draw", F.lit(1))
        per_class = int(smallest)
    order = [rank_key(seed, F.col(id_col)), F.col(id_col)]
    taken = first_n(rows, ["class"], order, per_class, id_col)
    if strategy == "undersample":
        return taken.withColumn("draw", F.lit(1))
    large = taken.join(sizes.where(F.col("_n") >= per_class).select("class"), "class", "left_semi").withColumn("draw", F.lit(1))
    small = taken.join(sizes.where(F.col("_n") < per_class), "class").withColumn("_at", F.row_number().over(Window.partitionBy("class").orderBy(*order)) - 1)
    draws = sizes.where(F.col("_n") < per_class).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(per_class))))
    slot = F.pmod(F.conv(F.substring(rank_key(seed, F.col("class"), F.col("draw")), 1, 12), 16, 10).cast("long"), F.col("_n")).cast("int")
    drawn = draws.select("class", "draw", slot.alias("_at")).join(small.drop("_n"), ["class", "_at"]).drop("_at")
    return large.unionByName(drawn.select(*large.columns))


def political_sides(df: DataFrame, left: list[str], right: list[str], text: str = "text", matches: str | None = None) -> DataFrame:
    """Adds ``political_label``: left, right or neutral by keywords in the text or among matched keywords; rows with both drop out."""
    low = F.lower(text)

    def hit(words: list[str]) -> Column:
        out = F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(low, w)) if words else F.lit(False)
        return out | F.exists(matches, lambda m: F.lower(m).isin(*[w.lower() for w in words])) if matches and words else out

    is_left, is_right = hit(left), hit(right)
    label = F.when(is_left & ~is_right, "left").when(is_right & ~is_left, "right").when(~is_left & ~is_right, "neutral")
    return df.where(F.col(text).isNotNull()).withColumn("political_label", label).where("political_label is not null")


def political_balance(df: DataFrame, left: list[str], right: list[str], id_col: str, *, text: str = "text", per_side: int | None = None, neutral: bool = False, seed: int = 42) -> DataFrame:
    """As many of either side (the smaller one's number, or fewer), and at most as many neutral rows."""
    rows = political_sides(df, left, right, text)
    sizes = {r["political_label"]: r["n"] for r in rows.groupBy("political_label").agg(F.count("*").alias("n")).collect()}  # at most three rows
    n = min(sizes.get("left", 0), sizes.get("right", 0))
    n = min(n, per_side) if per_side else n
    wanted = ["left", "right", *(["neutral"] if neutral else [])]
    return first_n(rows.where(F.col("political_label").isin(*wanted)), ["political_label"], [rank_key(seed, F.col(id_col)), F.col(id_col)], n, id_col)


def split(df: DataFrame, id_col: str, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), *, stratify: str | None = None, seed: int = 42) -> DataFrame:
    """Adds ``split`` (train, validation, test): floor(n * ratio) rows each in hash order, the rest test.

    Stratified by the value of ``stratify`` (of a list its first element; null and empty: unknown).
    """
    if abs(sum(ratios) - 1) > 0.001:
        raise ValueError("the ratios must sum to 1")
    stratum: Column = F.lit("all")
    if stratify:
        c = F.try_element_at(F.col(stratify), F.lit(1)) if dict(df.dtypes)[stratify].startswith("array") else F.col(stratify)
        stratum = F.when(c.cast("string") == "", "unknown").otherwise(F.coalesce(c.cast("string"), F.lit("unknown")))
    rows = df.withColumn("_s", stratum).withColumn("_k", rank_key(seed, F.col(id_col)))
    ranked = _ranked(rows, id_col)
    train, val = F.floor(F.col("_n") * ratios[0]), F.floor(F.col("_n") * ratios[1])
    return ranked.withColumn("split", F.when(F.col("_rank") <= train, "train").when(F.col("_rank") <= train + val, "validation").otherwise("test")).drop("_s", "_k", "_n", "_rank", "_b")


#: Rows of one bucket, about, while ranks are taken.
BUCKET_ROWS = 100_000


def _ranked(rows: DataFrame, id_col: str) -> DataFrame:
    """Rank in hash order within the stratum, in two steps: inside hash buckets and over bucket sizes.

    The number of buckets follows the number of rows, so one stratum of all rows spreads over as many tasks as it needs.
    """
    digits = 2
    most = rows.count()
    while most > BUCKET_ROWS * 16**digits:
        digits += 1
    rows = rows.withColumn("_b", F.substring("_k", 1, digits))  # in hash order
    sizes = rows.groupBy("_s", "_b").agg(F.count("*").alias("_c"))
    w = Window.partitionBy("_s").orderBy("_b")
    sizes = sizes.select(F.col("_s"), F.col("_b"), (F.sum("_c").over(w) - F.col("_c")).alias("_base"), F.sum("_c").over(Window.partitionBy("_s")).alias("_n"))
    inside = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_k", id_col))
    return rows.withColumn("_in", inside).join(sizes, ["_s", "_b"]).withColumn("_rank", F.col("_base") + F.col("_in")).drop("_base", "_in")


def sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (all, if there are fewer): the least hashes."""
    return df.orderBy(rank_key(seed, F.col(id_col)), id_col).limit(n)


def input_order(df: DataFrame) -> Column:
    """Place of a row in its input: file, then row of the file; rows that come from no file keep the order of their partitions."""
    for place in ("_metadata.row_index", "_metadata.file_block_start"):
        try:
            df.select(place)
        except AnalysisException:
            continue
        return F.struct(F.col("_metadata.file_path").alias("file"), F.col(place).alias("at"), F.monotonically_increasing_id().alias("n"))
    return F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("at"), F.monotonically_increasing_id().alias("n"))


def merge(frames: list[DataFrame], id_col: str = "id", order: str | None = None) -> DataFrame:
    """Union of at least two inputs by name, the first row per id in the order of the inputs, then of ``order`` or of the rows.

    Rows without the id column take a hash of their content; rows with a null id collapse to one. The
    column ``order`` is compared as what it is; inputs that give it different types are an error.
    """
    if len(frames) < 2:
        raise ValueError("at least two inputs are needed")
    if order and len({dict(df.dtypes)[order] for df in frames}) > 1:
        raise ValueError(f"the inputs give {order} different types")
    parts = []
    for i, df in enumerate(frames):
        if id_col in df.columns:
            key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
        else:
            key = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
        at = F.col(order) if order else input_order(df)
        parts.append(df.select("*", key.alias("_key"), F.struct(F.lit(i).alias("f"), at.alias("o")).alias("_order")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    names = [c for c in out.columns if c not in ("_key", "_order")]
    kept = out.groupBy("_key").agg(F.min_by(F.struct(*names), F.col("_order")).alias("r"))
    return kept.select("r.*")
