"""Campaign finance: searches over stored candidates, committees and contributions, and their paged source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from agorasift.sources.paged import fetcher
from agorasift.sources.ratelimit import Refused, SlidingWindow, retrying

# The three record types.
SCHEMAS = {
    "candidates": "candidate_id string, name string, party string, office string, state string, district string, election_years array<int>, incumbent_challenge string, candidate_status string",
    "committees": "committee_id string, name string, committee_type string, designation string, party string, state string, treasurer_name string",
    "contributions": "contribution_id string, contributor_name string, contributor_city string, contributor_state string, contribution_amount double, contribution_date string, committee_id string, committee_name string, candidate_id string",
}


def _like(c: str, q: str | None) -> Column | None:
    return F.contains(F.lower(c), F.lit(q.lower())) if q else None


def _all(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for c in conditions:
        if c is not None:
            df = df.where(c)
    return df


def candidates(df: DataFrame, q: str | None = None, election_year: int | None = None, office: str | None = None, party: str | None = None, state: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest election first, then id."""
    year = F.array_contains("election_years", election_year) if election_year else None
    rows = _all(df, _like("name", q), year, *[F.col(k) == v if v else None for k, v in (("office", office), ("party", party), ("state", state))])
    rows = rows.orderBy(F.array_max("election_years").desc_nulls_last(), "candidate_id")
    return rows.limit(limit) if limit else rows


def committees(df: DataFrame, q: str | None = None, types: list[str] | None = None, party: str | None = None, state: str | None = None, limit: int | None = None) -> DataFrame:
    kinds = F.col("committee_type").isin(*types) if types else None
    rows = _all(df, _like("name", q), kinds, *[F.col(k) == v if v else None for k, v in (("party", party), ("state", state))]).orderBy("committee_id")
    return rows.limit(limit) if limit else rows


def date_of(c: Column) -> Column:
    """Dates in ISO form (with or without a time) or month/day/year; others give null."""
    return F.coalesce(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"), F.try_to_date(c, "MM/dd/yyyy"))


def contributions(df: DataFrame, name: str | None = None, committee_id: str | None = None, min_amount: float | None = None, max_amount: float | None = None, period: int | None = None, limit: int | None = None) -> DataFrame:
    """By contributor or committee, amount and two-year period (named by its even year); newest first."""
    day = date_of(F.col("contribution_date"))
    in_period = F.year(day).isin(period - 1, period) if period else None
    rows = _all(
        df, _like("contributor_name", name), F.col("committee_id") == committee_id if committee_id else None,
        F.col("contribution_amount") >= min_amount if min_amount is not None else None, F.col("contribution_amount") <= max_amount if max_amount is not None else None, in_period,
    ).dropDuplicates(["contribution_id"])
    rows = rows.withColumn("receipt_date", day).orderBy(F.desc_nulls_last("receipt_date"), "contribution_id")
    return rows.limit(limit) if limit else rows


def candidate_totals(rows: DataFrame, election_year: int | None = None) -> DataFrame:
    """``candidate_id, receipts, contributions, contributors, largest``; repeated rows count once.

    ``election_year`` (even): only its two-year period counts.
    """
    if election_year:
        rows = rows.where(F.year(date_of(F.col("contribution_date"))).isin(election_year - 1, election_year))
    one = rows.where("candidate_id is not null").dropDuplicates(["contribution_id"])
    return one.groupBy("candidate_id").agg(F.round(F.sum("contribution_amount"), 2).alias("receipts"), F.count("*").alias("contributions"), F.count_distinct("contributor_name").alias("contributors"), F.max("contribution_amount").alias("largest"))


class _Page(InputPartition):
    def __init__(self, page: int, pages: int) -> None:
        self.page, self.pages = page, pages


def _requests(options: dict, parts: int) -> Callable:
    """The fetcher under the hourly limit (``perhour``, shared by the partitions), tried again after refusals."""
    window = SlidingWindow(max(1, int(options.get("perhour", "1000")) // max(1, parts)))
    fetch = fetcher(options["fetch"])

    def once(kind: str, page: int, opts: dict) -> tuple:
        window.wait()
        return fetch(kind, page, opts)

    return retrying(once, int(options.get("attempts", "5")), float(options.get("basedelay", "2")), float(options.get("maxdelay", "60")), (OSError, Refused))


class _Reader(DataSourceReader):
    """After the first page the number of pages is known, and the rest is read in parallel.

    Filters (``q``, ``office``, ``min_amount`` and so on) are options, which the fetcher sends along.
    """

    def __init__(self, options: dict, kind: str) -> None:
        self.options, self.kind = dict(options), kind
        self.columns = [p.split()[0] for p in SCHEMAS[kind].split(", ")]

    def partitions(self) -> list[_Page]:
        _, pages = _requests(self.options, 1)(self.kind, 1, self.options)
        return [_Page(k, int(pages)) for k in range(1, int(pages) + 1)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        rows, _ = _requests(self.options, partition.pages)(self.kind, partition.page, self.options)
        for r in rows:
            yield tuple(r.get(c) for c in self.columns)


class _Stream(SimpleDataSourceStreamReader):
    """One page a batch, as far as there are pages; a page number is all there is to resume from."""

    def __init__(self, options: dict, kind: str) -> None:
        self.reader, self._fetch = _Reader(options, kind), None

    @property
    def fetch(self) -> Callable:  # made where it runs
        if self._fetch is None:
            self._fetch = _requests(self.reader.options, 1)
        return self._fetch

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_fetch": None}

    def initialOffset(self) -> dict:
        return {"page": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, pages = self.fetch(self.reader.kind, start["page"] + 1, self.reader.options)
        if start["page"] >= int(pages):
            return iter([]), start
        return iter([tuple(r.get(c) for c in self.reader.columns) for r in rows]), {"page": start["page"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for page in range(start["page"], end["page"]):
            yield from self.read({"page": page})[0]


class FinancePages(DataSource):
    """``spark.read.format("finance_pages").option("kind", "candidates").option("fetch", "module:function")``."""

    @classmethod
    def name(cls) -> str:
        return "finance_pages"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "candidates")]

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options, self.options.get("kind", "candidates"))

    def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
        return _Stream(self.options, self.options.get("kind", "candidates"))


def recorded_finance(kind: str, page: int, options: dict) -> tuple[list[dict], int]:
    """Pages from a JSON file: kind -> list of pages."""
    with open(options["path"]) as f:
        pages = json.load(f).get(kind, [])
    return (pages[page - 1] if page <= len(pages) else []), len(pages)
