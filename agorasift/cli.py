"""Command line: ``python -m agorasift.cli GROUP COMMAND``; every command reads items and writes items."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorasift import config
from agorasift.operators import classify, clean, keywords, privacy, sampling
from agorasift.sources import finance, paged
from agorasift.sources.store import read_items, write_items


def _session() -> SparkSession:
    return SparkSession.builder.appName("agorasift").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _out(df: DataFrame, args: argparse.Namespace, kind: str) -> None:
    write_items(df, args.output, args.format, {"command": kind, "options": {k: v for k, v in vars(args).items() if k != "run"}})


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    spark.dataSource.register(paged.TweetPages)
    texts = a.query
    if a.user:
        texts = [paged.user_text(u, a.replies, a.forwards) for u in a.user]
    elif a.keywords:
        texts = [r["keyword"] for r in keywords.load_dictionaries(spark, a.keywords).select("keyword").orderBy("keyword").collect()]
    if a.archive_days and a.since and a.until:  # stretches of the period are read side by side
        texts = paged.archive_texts(texts, a.since, a.until, a.archive_days, a.language)
    else:
        texts = [paged.search_text(q, a.since, a.until, a.language) for q in texts]
    options = config.source_options(config.load(a.settings)) | ({"fetch": a.fetch} if a.fetch else {})
    reader = spark.read.format("tweet_pages").options(**options).option("queries", json.dumps(texts)).option("maxresults", a.max_results)
    for pair in a.option:
        reader = reader.option(*pair.split("=", 1))
    _out(reader.load(), a, "collect")


def collect_finance(spark: SparkSession, a: argparse.Namespace) -> None:
    spark.dataSource.register(finance.FinancePages)
    options = config.source_options(config.load(a.settings)) | ({"fetch": a.fetch} if a.fetch else {})
    reader = spark.read.format("finance_pages").options(**options).option("kind", a.kind)
    for pair in a.option:
        reader = reader.option(*pair.split("=", 1))
    _out(reader.load(), a, "finance")


def run_clean(spark: SparkSession, a: argparse.Namespace) -> None:
    cfg = clean.CleanConfig(remove_urls=a.remove_urls, remove_mentions=a.remove_mentions, normalize_hashtags=a.normalize_hashtags, min_length=a.min_length)
    rows = clean.keep_clean(read_items(spark, a.input), a.text, a.language, cfg)
    _out(rows.withColumn(a.text, F.col("cleaning.cleaned")).withColumn("language", F.col("cleaning.language")), a, "clean")


def run_detect(spark: SparkSession, a: argparse.Namespace) -> None:
    words = keywords.load_dictionaries(spark, a.keywords) if a.keywords else keywords.built_in(spark)
    _out(classify.detect(read_items(spark, a.input), words, a.text, a.min_score), a, "detect")


def run_anonymize(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(privacy.anonymize_items(read_items(spark, a.input), a.salt, a.text if a.remove_pii else None), a, "anonymize")


def run_merge(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(sampling.merge([read_items(spark, p) for p in a.inputs], a.id), a, "merge")


def run_stats(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = read_items(spark, a.input)
    clean.text_stats(rows, a.text).show(truncate=False)
    if "language" in rows.columns:
        clean.histogram(rows, "language", 10).show(truncate=False)


def run_by_class(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(sampling.by_class(read_items(spark, a.input), a.field, a.id, per_class=a.per_class, strategy=a.strategy, seed=a.seed), a, "by-class")


def run_political(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(sampling.political_balance(read_items(spark, a.input), a.left.split(","), a.right.split(","), a.id, text=a.text, per_side=a.per_side, neutral=a.neutral, seed=a.seed), a, "political")


def run_split(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = sampling.split(read_items(spark, a.input), a.id, tuple(a.ratios), stratify=a.stratify, seed=a.seed)
    _out(rows, a, "split")


def run_sample(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(sampling.sample(read_items(spark, a.input), a.n, a.id, a.seed), a, "sample")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="agorasift")
    groups = top.add_subparsers(required=True)

    def group(name: str):  # noqa: ANN202
        return groups.add_parser(name).add_subparsers(required=True)

    def command(g, name: str, run, inputs: str = "one") -> argparse.ArgumentParser:  # noqa: ANN001
        p = g.add_parser(name)
        if inputs == "one":
            p.add_argument("input")
        elif inputs == "many":
            p.add_argument("inputs", nargs="+")
        p.add_argument("--output", default=None)
        p.add_argument("--format", choices=["parquet", "json", "csv"], default="parquet")
        p.add_argument("--text", default="text")
        p.add_argument("--id", default="id")
        p.set_defaults(run=run)
        return p

    c = group("collect")
    p = command(c, "tweets", collect, "none")
    p.add_argument("--query", action="append", default=[])
    p.add_argument("--user", action="append", default=[])
    p.add_argument("--keywords")
    p.add_argument("--no-replies", dest="replies", action="store_false")
    p.add_argument("--no-forwards", dest="forwards", action="store_false")
    for o in ("--since", "--until", "--language"):
        p.add_argument(o)
    p.add_argument("--max-results", type=int, default=1000)
    p.add_argument("--archive-days", type=int, default=0, help="split the period into stretches of so many days")
    f = command(c, "finance", collect_finance, "none")
    f.add_argument("--kind", choices=list(finance.SCHEMAS), default="candidates")
    for x in (p, f):
        x.add_argument("--fetch")
        x.add_argument("--settings", action="append", default=[], help="JSON files of settings")
        x.add_argument("--option", action="append", default=[])

    defaults = config.load()
    g = group("preprocess")
    p = command(g, "clean", run_clean)
    p.add_argument("--keep-urls", dest="remove_urls", action="store_false")
    p.add_argument("--remove-mentions", action="store_true")
    p.add_argument("--keep-hashtags", dest="normalize_hashtags", action="store_false")
    p.add_argument("--language", default=defaults["clean.language"])
    p.add_argument("--min-length", type=int, default=defaults["clean.min_length"])
    p = command(g, "detect", run_detect)
    p.add_argument("--keywords")
    p.add_argument("--min-score", type=float, default=defaults["detect.min_score"])
    p = command(g, "anonymize", run_anonymize)
    p.add_argument("--salt", default=defaults["privacy.salt"])
    p.add_argument("--keep-pii", dest="remove_pii", action="store_false")
    command(g, "merge", run_merge, "many")
    command(g, "stats", run_stats)

    b = group("balance")
    p = command(b, "by-class", run_by_class)
    p.add_argument("--field", required=True)
    p.add_argument("--per-class", type=int)
    p.add_argument("--strategy", default="undersample")
    q = command(b, "political", run_political)
    q.add_argument("--left", required=True)
    q.add_argument("--right", required=True)
    q.add_argument("--per-side", type=int)
    q.add_argument("--neutral", action="store_true")
    r = command(b, "split", run_split)
    r.add_argument("--ratios", type=float, nargs=3, default=[0.8, 0.1, 0.1])
    r.add_argument("--stratify")
    s = command(b, "sample", run_sample)
    s.add_argument("--n", type=int, required=True)
    for x in (p, q, r, s):
        x.add_argument("--seed", type=int, default=42)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    args.run(_session(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
