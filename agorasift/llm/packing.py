"""Packing documents into windows of fixed capacity (problem 8): vector best-fit.

Every document is measured in tokens of a public tokenizer. A window has three capacities: tokens,
documents, and attention cost (the sum of squared lengths). A document that alone exceeds the token
capacity is cut into full pieces and a rest; no other document is cut. Pieces are dealt by hash to
shards of bounded size, and each shard is packed on its own, largest piece first: among the open
windows that hold the piece under every constraint, the one with the least weighted residual norm
(or the greatest weighted dot product of residual and size) takes it.

A shard fills about ``WINDOWS`` windows, so what the last, half-empty windows of a shard waste is a
small share at any scale, and no task sees more than a shard.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorasift.session import cut

#: The public pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Windows that a shard fills, and pieces that it holds, about.
WINDOWS, PIECES = 1000, 20_000


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):  # noqa: ANN202
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_tokens(documents: DataFrame, text: str = "text", *, path: str, pattern: str = PATTERN) -> DataFrame:
    """``documents`` with ``tokens``: the number of tokens of the whole text; null texts have 0."""

    @F.pandas_udf("int")
    def count(s: pd.Series) -> pd.Series:
        e = _encoding(path, pattern)
        return s.map(lambda x: len(e.encode_ordinary(x)) if x else 0).astype("int32")

    return documents.withColumn("tokens", count(F.col(text)))


def best_fit(tokens: np.ndarray, capacity: int, max_docs: int, max_attention: float, weights: tuple[float, float, float] = (1.0, 0.1, 0.25), rule: str = "norm") -> np.ndarray:
    """Window number of each piece. A piece that alone exceeds the attention capacity has a window to itself."""
    order = np.argsort(-tokens, kind="stable")
    size = np.stack([tokens / capacity, np.full(len(tokens), 1 / max_docs), tokens.astype(float) ** 2 / max_attention], 1)
    w = np.array(weights)
    free, names = np.empty((1024, 3)), np.empty(1024, int)  # residuals of the open windows
    n = made = 0
    out = np.empty(len(tokens), int)
    least = tokens.min() / capacity if len(tokens) else 0.0
    for step, i in enumerate(order):
        s = size[i]
        best = -1
        if n:
            rest = free[:n] - s
            ok = np.flatnonzero((rest >= -1e-12).all(1))
            if len(ok):
                best = int(ok[((free[ok] * s) @ w).argmax()] if rule == "dot" else ok[(rest[ok] ** 2 @ w).argmin()])
        if best < 0:
            if n == len(free):
                free, names = np.concatenate([free, np.empty_like(free)]), np.concatenate([names, np.empty_like(names)])
            free[n], names[n], best = 1.0, made, n
            n, made = n + 1, made + 1
        free[best] -= s
        out[i] = names[best]
        if step % 256 == 255 and n:  # windows that nothing fits any more are closed
            keep = np.flatnonzero((free[:n, 0] >= least - 1e-12) & (free[:n, 1] > 0) & (free[:n, 2] > 0))
            free[: len(keep)], names[: len(keep)] = free[keep], names[keep]
            n = len(keep)
    return out


_PACKED = T.StructType().add("window_id", "long").add("bin", "string").add("doc_id", "long").add("piece", "integer").add("tok_start", "long").add("tok_end", "long")


def pack(documents: DataFrame, windows: DataFrame, *, path: str, attention_share: float = 1.0, tokens_per_doc: int = 16, rule: str = "norm", pattern: str = PATTERN) -> DataFrame:
    """``window_id, bin, doc_id, piece, tok_start, tok_end``: every document's pieces per kind of window.

    ``path``: the vocabulary file of a public tokenizer, readable on every executor.
    ``attention_share``: attention capacity as a share of capacity squared; a document whose own cost exceeds it has a window to itself. At most capacity /
    ``tokens_per_doc`` documents (8 at least) share a window. Documents of no token (null or empty
    text) get one row with ``bin`` null. Null ids are left out; repeated rows count once. Window
    kinds without a positive capacity are left out.
    """
    docs = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").dropDuplicates(["doc_id"])
    sizes = cut(with_tokens(docs, path=path, pattern=pattern).select("doc_id", "tokens"))
    kinds = windows.where("capacity_tokens > 0 and window_id is not null").select(F.col("window_id").cast("long"), F.col("capacity_tokens").cast("long").alias("cap")).distinct()
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("docs")).first()
    per_kind = [(r["window_id"], r["cap"], max(1, -(-total["tokens"] // (r["cap"] * WINDOWS)), -(-total["docs"] // PIECES))) for r in kinds.collect()]  # the kinds of windows: a configuration table
    if not per_kind:
        return sizes.sparkSession.createDataFrame([], _PACKED)
    plan = sizes.sparkSession.createDataFrame(per_kind, "window_id long, cap long, shards long")  # one row per kind of window
    whole = F.col("tokens") > 0
    pieces = sizes.where(whole).join(F.broadcast(plan)).withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("tokens") / F.col("cap")).cast("int") - 1)))
    pieces = pieces.select(
        "window_id", "cap", "doc_id", "piece", (F.col("piece") * F.col("cap")).alias("tok_start"), F.least(F.col("tokens"), (F.col("piece") + 1) * F.col("cap")).alias("tok_end"),
        F.pmod(F.xxhash64("doc_id", "piece"), F.col("shards")).alias("shard"),
    )

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        kind, shard = key
        pdf = pdf.sort_values(["doc_id", "piece"])
        cap = int(pdf["cap"].iloc[0])
        size = (pdf["tok_end"] - pdf["tok_start"]).to_numpy()
        bins = best_fit(size, cap, max(8, cap // tokens_per_doc), attention_share * cap * cap, rule=rule)
        return pdf.assign(bin=[f"{shard}:{b}" for b in bins])[[f.name for f in _PACKED]]

    empty = sizes.where(~whole).join(F.broadcast(plan)).select("window_id", F.lit(None).cast("string").alias("bin"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("tok_start"), F.lit(0).cast("long").alias("tok_end"))
    return pieces.groupBy("window_id", "shard").applyInPandas(work, _PACKED).unionByName(empty)


def fill_report(packed: DataFrame, windows: DataFrame) -> DataFrame:
    """``window_id, windows, documents, cut_documents, tokens, fill`` per kind of window."""
    rows = packed.where("bin is not null")
    per = rows.groupBy("window_id").agg(F.count_distinct("bin").alias("windows"), F.count_distinct("doc_id").alias("documents"), F.count_distinct(F.when(F.col("piece") > 0, F.col("doc_id"))).alias("cut_documents"), F.sum(F.col("tok_end") - F.col("tok_start")).alias("tokens"))
    return per.join(windows.select("window_id", "capacity_tokens"), "window_id").select("window_id", "windows", "documents", "cut_documents", "tokens", F.round(F.col("tokens") / (F.col("windows") * F.col("capacity_tokens")), 4).alias("fill"))
