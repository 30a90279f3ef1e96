"""Consensus from several annotators' labels (problem 2).

Expectation-maximisation over per-annotator confusion matrices: the posterior of an item's label is
the product of the class prior and of each annotator's row of confusion probabilities; the
matrices are then estimated anew from the posteriors. Matrices are smoothed towards the pooled
matrix of all annotators, so rare annotators behave like the average one. Both label fields run
through the same rounds.

The labels are laid out once, one row per item; a round is one pass over them without a shuffle of
labels, with the expected counts (annotator, label given, label meant) as the only state. While the
annotators number at most ``ANNOTATORS`` that table is broadcast; beyond, the same rounds run as
joins. Rounds are extrapolated (squared steps) and end when no expected count moves by ``SETTLED``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorasift.functions.labels import canonical
from agorasift.session import cut

# The label names of the two fields in their order.
LEANINGS = ("FAR_LEFT", "LEFT", "CENTER_LEFT", "CENTER", "CENTER_RIGHT", "RIGHT", "FAR_RIGHT")
SENTIMENTS = ("VERY_NEGATIVE", "NEGATIVE", "NEUTRAL", "POSITIVE", "VERY_POSITIVE")
FIELDS = {"political_leaning": LEANINGS, "sentiment": SENTIMENTS}
WIDTH = max(map(len, FIELDS.values()))
SIZES = [len(x) for x in FIELDS.values()]
#: Annotators up to which the table of counts (74 numbers each, 12 MB in all) is held in the driver and broadcast.
ANNOTATORS = 20_000
#: Rounds end when no expected count of labels moves by more than this.
SETTLED = 0.02
#: Passes after which the rounds end unsettled, with a warning.
PASSES = 200


def current_annotations(annotations: DataFrame) -> DataFrame:
    """One row per (item, annotator): the latest created_at counts, ties by the larger seq."""
    rows = annotations.where("item_id is not null and annotator_id is not null")
    newest = F.max_by(F.struct(*FIELDS), F.struct(F.coalesce("created_at", F.lit("0001-01-01").cast("timestamp")), F.coalesce("seq", F.lit(-1))))
    return rows.groupBy("item_id", "annotator_id").agg(newest.alias("r")).select("item_id", "annotator_id", *[F.col(f"r.{f}").alias(f) for f in FIELDS])


def label_rows(current: DataFrame) -> DataFrame:
    """``kind, item_id, annotator_id, l`` (l: index of the label); UNKNOWN, null and odd labels give none."""
    kinds = F.array(*[F.struct(F.lit(f).alias("kind"), (F.array_position(F.array(*map(F.lit, names)), canonical(F.col(f))) - 1).alias("l")) for f, names in FIELDS.items()])
    return current.select("item_id", "annotator_id", F.explode(kinds).alias("x")).select("x.kind", "item_id", "annotator_id", F.col("x.l").cast("int").alias("l")).where("l >= 0")


def _p(k: int) -> str:
    return f"p{k}"


PS = [_p(k) for k in range(WIDTH)]


def _size() -> Column:
    return F.when(F.col("kind") == "sentiment", len(SENTIMENTS)).otherwise(len(LEANINGS))


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs)
    e = [F.exp(x - top) for x in logs]
    total = reduce(lambda x, y: x + y, e)
    return [x / total for x in e]


def _maximise(labels: DataFrame, posterior: DataFrame) -> DataFrame:
    """Expected counts p0.. per kind, annotator and given label, from posteriors p0.. per (kind, item)."""
    return cut(labels.join(posterior, ["kind", "item_id"]).groupBy("kind", "annotator_id", "l").agg(*[F.sum(p).alias(p) for p in PS]))


def _parameters(c: DataFrame, smoothing: float) -> tuple[DataFrame, DataFrame]:
    """(log confusion per kind, annotator, label; log prior per kind) from expected counts."""
    pooled = c.groupBy("kind", "l").agg(*[F.sum(p).alias(f"g{k}") for k, p in enumerate(PS)])
    of_kind = Window.partitionBy("kind")
    # at most one row per label of a field: 12 rows
    pooled = pooled.select("kind", "l", *[((F.col(f"g{k}") + 0.5) / (F.sum(f"g{k}").over(of_kind) + 0.5 * _size())).alias(f"g{k}") for k in range(WIDTH)])
    own = Window.partitionBy("kind", "annotator_id")
    conf = c.join(F.broadcast(pooled), ["kind", "l"]).select(
        "kind", "annotator_id", "l",
        *[F.log((F.col(p) + smoothing * F.col(f"g{k}")) / (F.sum(p).over(own) + smoothing)).alias(f"c{k}") for k, p in enumerate(PS)],
    )
    # class shares, weighted by the number of labels; from the same counts, so a round is one pass
    mass = c.groupBy("kind").agg(*[F.sum(p).alias(p) for p in PS])
    total = reduce(lambda x, y: x + y, [F.col(p) for p in PS])
    prior = mass.select("kind", *[F.when(F.lit(k) < _size(), F.log((F.col(p) + 1) / (total + _size()))).otherwise(F.lit(-1e9)).alias(f"q{k}") for k, p in enumerate(PS)])
    return conf, prior


def _expect(labels: DataFrame, conf: DataFrame, prior: DataFrame) -> DataFrame:
    sums = labels.join(conf, ["kind", "annotator_id", "l"]).groupBy("kind", "item_id").agg(*[F.sum(f"c{k}").alias(f"s{k}") for k in range(WIDTH)])
    joined = sums.join(F.broadcast(prior), "kind")  # two rows
    logs = [F.col(f"s{k}") + F.col(f"q{k}") for k in range(WIDTH)]
    return joined.select("kind", "item_id", *[x.alias(_p(k)) for k, x in enumerate(_softmax(logs))])


def estimate(labels: DataFrame, smoothing: float = 6.0, passes: int = PASSES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(posterior per kind and item, log confusion, log prior), for any number of annotators, by joins.

    Starts from vote shares. ``smoothing`` counts as so many labels that follow the pooled matrix.
    Ends when no expected count moves by more than ``SETTLED``.
    """
    votes = labels.groupBy("kind", "item_id").agg(*[F.sum((F.col("l") == k).cast("double")).alias(f"v{k}") for k in range(WIDTH)], F.count("*").alias("n"))
    post = votes.select("kind", "item_id", *[F.when(F.lit(k) < _size(), (F.col(f"v{k}") + 0.1) / (F.col("n") + 0.1 * _size())).otherwise(F.lit(0.0)).alias(_p(k)) for k in range(WIDTH)])
    c = _maximise(labels, post)
    for _ in range(passes):
        new = _maximise(labels, _expect(labels, *_parameters(c, smoothing)))
        old = c.select("kind", "annotator_id", "l", *[F.col(p).alias(f"o{p}") for p in PS])
        moved = new.join(old, ["kind", "annotator_id", "l"]).agg(F.max(F.greatest(*[F.abs(F.col(p) - F.col(f"o{p}")) for p in PS]))).first()[0]
        c = new
        if moved is None or moved < SETTLED:
            break
    else:
        warnings.warn(f"expectation-maximisation had not settled after {passes} passes", stacklevel=2)
    conf, prior = (cut(x) for x in _parameters(c, smoothing))
    return _expect(labels, conf, prior), conf, prior


def _packed(current: DataFrame, names: list[str]) -> DataFrame:
    """``item_id, annotators, x``: one row per item, ``x`` its labels as annotator * 64 + leaning * 8 + sentiment (7: none)."""
    index = current.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "annotator_id string, _a int")  # at most ANNOTATORS rows
    place = [F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, labels)), canonical(F.col(f))), F.lit(0)) - 1, F.lit(7)) for f, labels in FIELDS.items()]
    code = F.col("_a") * 64 + (place[0] * 8 + place[1]).cast("int")
    return current.join(F.broadcast(index), "annotator_id").groupBy("item_id").agg(F.count("*").cast("int").alias("annotators"), F.collect_list(code).alias("x"))


def _flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(row of each label, annotator, given labels per field)."""
    sizes = pdf["x"].map(len).to_numpy()
    x = np.concatenate(pdf["x"].to_numpy()) if len(pdf) else np.empty(0, int)
    return np.repeat(np.arange(len(pdf)), sizes), x >> 6, [(x >> 3) & 7, x & 7]


def _logs(counts: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """(log confusion[annotator, given, meant], log prior) of one field from expected counts."""
    pooled = counts.sum(0) + 0.5
    pooled /= pooled.sum(0)
    mass = counts.sum((0, 1)) + 1
    return np.log((counts + smoothing * pooled) / (counts.sum(1, keepdims=True) + smoothing)), np.log(mass / mass.sum())


def _posterior(rows: np.ndarray, n: int, annotator: np.ndarray, given: np.ndarray, logs: tuple[np.ndarray, np.ndarray] | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(posterior per item and label, log factor of each label); vote shares without ``logs``."""
    if logs is None:
        z = np.bincount(rows * k + given, minlength=n * k).reshape(n, k) + 0.1
        return z / z.sum(1, keepdims=True), np.zeros((len(rows), k))
    w = logs[0][annotator, given]
    z = np.stack([np.bincount(rows, weights=w[:, j], minlength=n) for j in range(k)], 1) + logs[1]
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True), w


def _sums() -> list[Column]:
    return [F.sum(f"v{i}").alias(f"v{i}") for i in range(sum(k * k for k in SIZES))]


def _pass(items: DataFrame, logs: list | None, annotators: int, sums_of: list[Column]) -> list[np.ndarray]:
    """Expected counts [annotator, given, meant] per field under ``logs``: one pass over the items, small sums back."""
    given_out = items.sparkSession.sparkContext.broadcast(logs)  # bounded by ANNOTATORS
    names = [f"v{i}" for i in range(sum(k * k for k in SIZES))]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        params = given_out.value
        total = [np.zeros((annotators * k, k)) for k in SIZES]
        for pdf in batches:
            rows, annotator, fields = _flat(pdf)
            for f, k in enumerate(SIZES):
                ok = fields[f] < 7
                r, a, g = rows[ok], annotator[ok], fields[f][ok]
                post, _ = _posterior(r, len(pdf), a, g, params and params[f], k)
                for j in range(k):
                    total[f][:, j] += np.bincount(a * k + g, weights=post[r, j], minlength=annotators * k)
        flat = np.concatenate([t.reshape(annotators, -1) for t in total], 1)
        used = np.flatnonzero(flat.any(1))
        out = pd.DataFrame(flat[used], columns=names)
        out.insert(0, "a", used.astype("int32"))
        yield out

    sums = items.mapInPandas(work, "a int, " + ", ".join(f"{n} double" for n in names)).groupBy("a").agg(*sums_of).toPandas()
    given_out.destroy()
    whole = np.zeros((annotators, len(names)))
    whole[sums["a"].to_numpy(int)] = sums[names].to_numpy()
    cuts = np.cumsum([k * k for k in SIZES])[:-1]
    return [x.reshape(annotators, k, k) for x, k in zip(np.split(whole, cuts, axis=1), SIZES)]


def _ahead(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Squared extrapolation of two rounds of expected counts; what an annotator gave keeps its sum."""
    r = c1 - c0
    v = c2 - c1 - r
    norm = np.sqrt((v**2).sum())
    step = min(16.0, max(1.0, float(np.sqrt((r**2).sum()) / norm))) if norm else 1.0
    new = np.maximum(c0 + 2 * step * r + step * step * v, 0)
    have, want = new.sum(2, keepdims=True), c0.sum(2, keepdims=True)
    return np.where(have > 0, new * want / np.where(have > 0, have, 1), c2)


def _fit(items: DataFrame, annotators: int, smoothing: float, passes: int = PASSES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Log confusion and prior per field at the fixed point of the rounds."""

    def moved(a: list[np.ndarray], b: list[np.ndarray]) -> float:
        return max((float(np.abs(x - y).max(initial=0)) for x, y in zip(a, b)), default=0.0)

    sums_of = _sums()  # built once: a pass costs little else

    def next_counts(c: list[np.ndarray]) -> list[np.ndarray]:
        return _pass(items, [_logs(x, smoothing) for x in c], annotators, sums_of)

    c0 = _pass(items, None, annotators, sums_of)
    for done in range(1, passes, 2):
        c1 = next_counts(c0)
        if moved(c0, c1) < SETTLED:
            return [_logs(x, smoothing) for x in c1]
        c2 = next_counts(c1)
        if moved(c1, c2) < SETTLED:
            return [_logs(x, smoothing) for x in c2]
        c0 = c2 if done < 2 else [_ahead(x, y, z) for x, y, z in zip(c0, c1, c2)]
    warnings.warn(f"expectation-maximisation had not settled after {passes} passes", stacklevel=2)
    return [_logs(x, smoothing) for x in c0]


def _label_items(items: DataFrame, logs: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``kind, item_id, label, probability, annotators`` of items with at least two annotators and a usable label."""
    given_out = items.sparkSession.sparkContext.broadcast(logs)  # bounded by ANNOTATORS

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, annotator, fields = _flat(pdf)
            for f, (kind, names) in enumerate(FIELDS.items()):
                ok = fields[f] < 7
                r = rows[ok]
                post, _ = _posterior(r, len(pdf), annotator[ok], fields[f][ok], given_out.value[f], len(names))
                has = np.unique(r)
                best = post[has].argmax(1)
                yield pd.DataFrame({"kind": kind, "item_id": pdf["item_id"].to_numpy()[has], "label": np.array(names, object)[best], "probability": post[has, best], "annotators": pdf["annotators"].to_numpy()[has]})

    return items.where("annotators >= 2").mapInPandas(work, "kind string, item_id string, label string, probability double, annotators long")


def _reliability(items: DataFrame, logs: list[tuple[np.ndarray, np.ndarray]], names: list[str]) -> DataFrame:
    """``annotator_id, n, hits, expected``: each label against the posterior of the item's other annotators."""
    given_out = items.sparkSession.sparkContext.broadcast(logs)  # bounded by ANNOTATORS
    columns = [f"{x}{f}_{j}" for f, k in enumerate(SIZES) for x in "nht" for j in range(k)]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), len(columns)))
        for pdf in batches:
            rows, annotator, fields = _flat(pdf)
            at = 0
            for f, k in enumerate(SIZES):
                ok = fields[f] < 7
                r, a, g = rows[ok], annotator[ok], fields[f][ok]
                post, own = _posterior(r, len(pdf), a, g, given_out.value[f], k)
                z = np.log(np.maximum(post[r], 1e-300)) - own
                rest = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
                rest = rest / rest.sum(1, keepdims=True) if len(z) else z
                shape = (len(names), k)
                total[:, at : at + k] += np.bincount(a * k + g, minlength=len(names) * k).reshape(shape)
                total[:, at + k : at + 2 * k] += np.bincount(a * k + g, weights=rest[np.arange(len(g)), g], minlength=len(names) * k).reshape(shape)
                for j in range(k):
                    total[:, at + 2 * k + j] += np.bincount(a, weights=rest[:, j], minlength=len(names))
                at += 3 * k
        used = np.flatnonzero(total.any(1))
        out = pd.DataFrame(total[used], columns=columns)
        out.insert(0, "a", used.astype("int32"))
        yield out

    sums = items.where("annotators >= 2").mapInPandas(work, "a int, " + ", ".join(f"{c} double" for c in columns)).groupBy("a").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    n = hits = expected = 0.0
    for f, k in enumerate(SIZES):
        given, hit, meant = (sums[[f"{x}{f}_{j}" for j in range(k)]].to_numpy() for x in "nht")
        m = given.sum(1)
        n, hits = n + m, hits + hit.sum(1)
        expected = expected + (given * meant).sum(1) / np.maximum(m, 1)
    rows = [(names[int(a)], int(x), float(h), float(e)) for a, x, h, e in zip(sums["a"], n, hits, expected)] if len(sums) else []
    return items.sparkSession.createDataFrame(rows, "annotator_id string, n long, hits double, expected double")


def consensus(annotations: DataFrame, smoothing: float = 6.0, annotators: int = ANNOTATORS, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(consensus per ``kind, item_id``; reliability per annotator).

    Consensus: ``label, probability, annotators`` for items with at least two different annotators
    and a usable label; ties go to the label that comes first in its field's order. Reliability: ``n, hits, expected,
    skill, z``: ``hits`` are the labels' agreement with the consensus of the *other* annotators,
    ``expected`` what the same label habits would hit by chance, ``skill`` = (hits - expected) /
    (n - expected). Annotators without a usable label give no row; an empty table gives empty results.
    More than ``annotators`` annotators are worked by joins, with the same result up to where rounds end.
    """
    current = current_annotations(annotations)
    ids = annotations.where("annotator_id is not null").select("annotator_id").distinct().limit(annotators + 1).collect()
    if len(ids) > annotators:
        labelled, per = _by_joins(cut(current), smoothing, passes)
    else:
        names = sorted(r["annotator_id"] for r in ids)
        items = cut(_packed(current, names))
        logs = _fit(items, len(names), smoothing, passes)
        labelled, per = _label_items(items, logs), _reliability(items, logs, names)
    skill = (F.col("hits") - F.col("expected")) / F.greatest(F.col("n") - F.col("expected"), F.lit(1e-9))
    width = F.sqrt(F.greatest(F.col("expected") * (1 - F.col("expected") / F.col("n")), F.lit(1e-9)))
    return labelled, per.withColumn("skill", skill).withColumn("z", (F.col("hits") - F.col("expected")) / width)


def _by_joins(current: DataFrame, smoothing: float, passes: int) -> tuple[DataFrame, DataFrame]:
    labels = cut(label_rows(current))
    post, conf, _ = estimate(labels, smoothing, passes)
    post = cut(post)
    several = current.groupBy("item_id").agg(F.count("*").alias("annotators")).where("annotators >= 2")
    top = F.greatest(*PS)
    index = F.coalesce(*[F.when(F.col(p) == top, F.lit(k)) for k, p in enumerate(PS)])
    name = F.when(F.col("kind") == "sentiment", F.element_at(F.array(*map(F.lit, SENTIMENTS)), F.least(index, F.lit(len(SENTIMENTS) - 1)) + 1)).otherwise(F.element_at(F.array(*map(F.lit, LEANINGS)), index + 1))
    labelled = post.join(several, "item_id").select("kind", "item_id", name.alias("label"), top.alias("probability"), "annotators")

    # leave one out: take the annotator's own factor off the posterior
    rows = labels.join(post, ["kind", "item_id"]).join(conf, ["kind", "annotator_id", "l"])
    rows = rows.join(several.select("item_id"), "item_id", "left_semi")
    rest = _softmax([F.when(F.col(p) > 0, F.log(p)).otherwise(F.lit(-1e6)) - F.col(f"c{k}") for k, p in enumerate(PS)])
    rows = rows.select("kind", "annotator_id", "l", *[x.alias(_p(k)) for k, x in enumerate(rest)])
    hit = F.element_at(F.array(*PS), F.col("l") + 1)
    cells = rows.groupBy("kind", "annotator_id", "l").agg(F.count("*").alias("n"), F.sum(hit).alias("hits"))
    truth = rows.groupBy("kind", "annotator_id").agg(F.count("*").alias("m"), *[F.sum(p).alias(p) for p in PS])
    per = (
        cells.join(truth, ["kind", "annotator_id"])
        .withColumn("expected", F.col("n") * F.element_at(F.array(*PS), F.col("l") + 1) / F.col("m"))
        .groupBy("annotator_id")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum("expected").alias("expected"))
    )
    return labelled, per


def item_agreement(annotations: DataFrame) -> DataFrame:
    """Chance-corrected agreement per ``kind, item_id``: ``raters, observed, expected, kappa``.

    ``observed`` is the share of agreeing pairs of the item's annotators, ``expected`` that of two
    labels drawn from all labels of the field, ``kappa`` = (observed - expected) / (1 - expected),
    null where the field has one label only. Items with fewer than two usable labels give no row.
    """
    labels = label_rows(current_annotations(annotations))
    cells = labels.groupBy("kind", "item_id", "l").agg(F.count("*").alias("n"))
    items = cells.groupBy("kind", "item_id").agg(F.sum("n").alias("raters"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same"))
    freq = cells.groupBy("kind", "l").agg(F.sum("n").alias("m"))
    by_kind = freq.groupBy("kind").agg(F.sum(F.col("m") * F.col("m")).alias("sq"), F.sum("m").alias("t"))
    by_kind = by_kind.select("kind", (F.col("sq") / (F.col("t") * F.col("t"))).alias("expected"))
    observed = F.col("same") / (F.col("raters") * (F.col("raters") - 1))
    return (
        items.where("raters >= 2").join(F.broadcast(by_kind), "kind")  # two rows
        .select("kind", "item_id", "raters", observed.alias("observed"), "expected")
        .withColumn("kappa", F.when(F.col("expected") < 1, (F.col("observed") - F.col("expected")) / (1 - F.col("expected"))))
    )
