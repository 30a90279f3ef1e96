"""Paged sources as Python data sources, batch and streaming.

A source is a *fetcher*: ``fetch(query, token, options) -> (rows, next token or None)``. The options
name it as ``module:function``, so a live client, recorded pages or a test double plug in the same
way. Token paging is sequential: one partition per query, never per page. A numbered source gives
``pages`` and reads its pages in parallel.

Every request waits for its endpoint's rate limit and is tried again after a refusal (:func:`requests_of`).
A batch that ends early resumes from its log of finished pages (:class:`PageLog`).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import importlib
import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from agorasift.sources.ratelimit import Refused, for_tier, retrying

TWEET = (
    "id string, text string, created_at string, author_id string, author_username string, author_name string, author_verified boolean, conversation_id string, "
    "in_reply_to_user_id string, lang string, source string, retweet_count int, reply_count int, like_count int, quote_count int, hashtags array<string>, mentions array<string>, "
    "urls array<string>, is_reply boolean, is_retweet boolean, is_quote boolean, query string"
)
COLUMNS = [p.split()[0] for p in TWEET.split(", ")]
FETCH = {"recorded": "agorasift.sources.paged:recorded_pages"}


def fetcher(name: str):  # noqa: ANN201
    module, _, function = FETCH.get(name, name).partition(":")
    return getattr(importlib.import_module(module), function)


def requests_of(options: dict, parts: int = 1) -> Callable:
    """``fetch(query, token, options)`` of the options under its rate limit, tried again after refusals and network errors.

    Options: ``fetch``; ``tier`` and ``endpoint`` (no endpoint: no limit); ``attempts``, ``basedelay``,
    ``maxdelay`` in seconds. The limit holds over all ``parts`` partitions that run at once, each of
    which has its share. A refusal that names a delay waits that long.
    """
    limiter, endpoint = for_tier(options.get("tier", "basic"), share=1 / max(1, parts)), options.get("endpoint", "")
    fetch = fetcher(options.get("fetch", "recorded"))

    def once(query: str, token: object, opts: dict) -> tuple:
        limiter.acquire(endpoint)
        return fetch(query, token, opts)

    return retrying(once, int(options.get("attempts", "5")), float(options.get("basedelay", "2")), float(options.get("maxdelay", "300")), (OSError, Refused))


class PageLog:
    """Finished pages of one query in a folder, so that a collection that ended early goes on where it stopped.

    Every page is one file, written beside its place and renamed; it holds the rows and the next token.
    """

    def __init__(self, folder: str, query: str) -> None:
        self.folder = Path(folder) / hashlib.sha256(query.encode()).hexdigest()[:32]
        self.folder.mkdir(parents=True, exist_ok=True)

    def _path(self, page: int) -> Path:
        return self.folder / f"{page:08}.json"

    def get(self, page: int) -> tuple[list[dict], str | None] | None:
        p = self._path(page)
        if not p.exists():
            return None
        page_ = json.loads(p.read_text())
        return page_["rows"], page_["next"]

    def put(self, page: int, rows: list[dict], token: str | None) -> None:
        part = self._path(page).with_suffix(f".{os.getpid()}.part")
        part.write_text(json.dumps({"rows": rows, "next": token}))
        os.replace(part, self._path(page))


def date_ranges(start: str, end: str, days: int) -> list[tuple[str, str]]:
    """The period from ``start`` up to, not including, ``end`` in stretches of ``days`` days, so an archive is read in parallel."""
    a, b, out = dt.date.fromisoformat(start), dt.date.fromisoformat(end), []
    if days < 1:
        raise ValueError("at least one day")
    while a < b:
        upto = min(b, a + dt.timedelta(days=days))
        out.append((a.isoformat(), upto.isoformat()))
        a = upto
    return out


def archive_texts(queries: list[str], start: str, end: str, days: int = 30, lang: str | None = None) -> list[str]:
    """One search per query and stretch of the period; each becomes a partition of its own."""
    return [search_text(q, a, b, lang) for q in queries for a, b in date_ranges(start, end, days)]


def recorded_pages(query: str, token: str | None, options: dict) -> tuple[list[dict], str | None]:
    """Pages from a JSON file: query -> list of API pages (``data, includes, meta``)."""
    pages = json.loads(Path(options["path"]).read_text()).get(query, [])
    at = int(token or 0)
    if at >= len(pages):
        return [], None
    return parse_page(pages[at]), str(at + 1) if at + 1 < len(pages) else None


def parse_page(page: dict) -> list[dict]:
    """Nested API records as flat rows: author looked up, metrics 0 by default, kinds from references."""
    users = {u["id"]: u for u in (page.get("includes") or {}).get("users", [])}
    out = []
    for t in page.get("data") or []:
        u, m, e = users.get(t.get("author_id"), {}), t.get("public_metrics") or {}, t.get("entities") or {}
        kinds = {r.get("type") for r in t.get("referenced_tweets") or []}
        row = {
            "id": t.get("id"), "text": t.get("text"), "created_at": t.get("created_at"), "author_id": t.get("author_id"), "author_username": u.get("username"), "author_name": u.get("name"),
            "author_verified": bool(u.get("verified", False)), "conversation_id": t.get("conversation_id"), "in_reply_to_user_id": t.get("in_reply_to_user_id"), "lang": t.get("lang"), "source": t.get("source"),
            "hashtags": [x["tag"] for x in e.get("hashtags", [])], "mentions": [x["username"] for x in e.get("mentions", [])], "urls": [x.get("expanded_url") or x.get("url") for x in e.get("urls", [])],
            "is_reply": t.get("in_reply_to_user_id") is not None, "is_retweet": "retweeted" in kinds, "is_quote": "quoted" in kinds,
        }
        row |= {f"{k}_count": int(m.get(f"{k}_count", 0)) for k in ("retweet", "reply", "like", "quote")}
        out.append(row)
    return out


def search_text(query: str, since: str | None = None, until: str | None = None, lang: str | None = None) -> str:
    """A search query with its date and language suffixes."""
    return " ".join([query, *[f"{k}:{v}" for k, v in (("since", since), ("until", until), ("lang", lang)) if v]])


def user_text(user: str, replies: bool = True, forwards: bool = True) -> str:
    return " ".join([f"from:{user.lstrip('@')}", *([] if replies else ["-filter:replies"]), *([] if forwards else ["-filter:retweets"])])


class _Query(InputPartition):
    def __init__(self, query: str) -> None:
        self.query = query


def _row(r: dict, query: str) -> tuple:
    return tuple(query if c == "query" else r.get(c) for c in COLUMNS)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[_Query]:
        return [_Query(q) for q in dict.fromkeys(json.loads(self.options["queries"]))]

    def read(self, partition: _Query) -> Iterator[tuple]:
        fetch = requests_of(self.options, len(json.loads(self.options["queries"])))
        log = PageLog(self.options["resume"], partition.query) if self.options.get("resume") else None
        most, n, page, token = int(self.options.get("maxresults", "0")), 0, 0, None
        while True:
            done = log.get(page) if log else None
            rows, token = done or fetch(partition.query, token, self.options)
            if log and done is None:
                log.put(page, rows, token)
            page += 1
            for r in rows:
                if most and n >= most:
                    return
                n += 1
                yield _row(r, partition.query)
            if token is None or (most and n >= most):
                return


class _Stream(SimpleDataSourceStreamReader):
    """All queries in turn; the offset holds every query's next token, so rows and offset are committed together.

    A batch that is replayed gives the rows it gave: pages come from the log in ``resume``, which a
    fetcher whose pages may change needs; ``replay`` = ``same`` states that they do not change.
    """

    def __init__(self, options: dict) -> None:
        self.options = dict(options)
        self.queries = list(dict.fromkeys(json.loads(self.options["queries"])))
        if not self.options.get("resume") and self.options.get("replay", "same" if self.options.get("fetch", "recorded") == "recorded" else "") != "same":
            raise ValueError("a live fetcher needs the option resume: a folder for its pages")
        self._fetch: Callable | None = None
        self.logs = [PageLog(self.options["resume"], q) if self.options.get("resume") else None for q in self.queries]

    @property
    def fetch(self) -> Callable:  # made where it runs, as its lock does not travel
        if self._fetch is None:
            self._fetch = requests_of(self.options)
        return self._fetch

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_fetch": None}

    def initialOffset(self) -> dict:
        return {"tokens": [""] * len(self.queries), "pages": [0] * len(self.queries), "n": "0"}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        tokens, pages, out = list(start["tokens"]), list(start["pages"]), []
        for i, q in enumerate(self.queries):
            if tokens[i] == "end":
                continue
            done = self.logs[i].get(pages[i]) if self.logs[i] else None
            rows, token = done or self.fetch(q, tokens[i] or None, self.options)
            if self.logs[i] and done is None:
                self.logs[i].put(pages[i], rows, token)
            tokens[i], pages[i] = token or "end", pages[i] + 1
            out += [_row(r, q) for r in rows]
        return iter(out), {"tokens": tokens, "pages": pages, "n": str(int(start["n"]) + len(out))}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at, out = start, []
        while at != end:
            rows, at = self.read(at)
            out += list(rows)
        return iter(out)


class TweetPages(DataSource):
    """``spark.read.format("tweet_pages").option("queries", '["q1", "q2"]')`` with ``fetch``, ``maxresults``, ``resume`` (a folder for finished pages), limits and retries as in :func:`requests_of`, and the fetcher's own options."""

    @classmethod
    def name(cls) -> str:
        return "tweet_pages"

    def schema(self) -> str:
        return TWEET

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
        return _Stream(self.options)
