"""python tools/row_loop.py [FOLDER]: seconds of single-threaded Python loops over rows for some queries of the bench.

The loops compute what the queries of the same names compute, one row after another, reading included;
prints one JSON line, the median of three runs each.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import statistics
import sys
import time
import unicodedata
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from agorasift.operators.keywords import BUILT_IN  # noqa: E402
from agorasift.operators.privacy import PATTERNS, settle, spans_in  # noqa: E402

URL, TAG, MENTION, MARKS, FORWARD = re.compile(r"https?://\S+|www\.\S+"), re.compile(r"#(\w+)"), re.compile(r"@\w+"), re.compile(r"([!?.]){2,}"), re.compile(r"^RT\s*@\w+:\s*", re.I)
SMALL = {"en": "the and of to in is that for", "de": "der die das und ist nicht", "es": "el la los que y en", "fr": "le les des et est une"}


def rows(folder: str, name: str, columns: list[str]) -> list[dict]:
    return pq.read_table(f"{folder}/{name}.parquet", columns=columns).to_pylist()


def clean_pipeline(d: str) -> int:
    n = 0
    for r in rows(d, "tweets", ["tweet_id", "text_raw"]):
        t = unicodedata.normalize("NFKC", html.unescape(r["text_raw"]))
        t = FORWARD.sub("", t)
        MENTION.findall(t), TAG.findall(t)
        t = MARKS.sub(r"\1", TAG.sub(r"\1", URL.sub(" ", t)))
        t = " ".join(t.split())
        words = Counter(t.lower().split())
        max(SMALL, key=lambda k: sum(words[w] for w in SMALL[k].split()))
        n += len(t)
    return n


def extract_hashtags(d: str) -> int:
    return sum(len(TAG.findall(r["text_raw"])) for r in rows(d, "tweets", ["text_raw"]))


def keyword_score(d: str) -> int:
    words = [(w.lower(), weight) for weight, text in BUILT_IN.values() for w in text.split()]
    words += [(r["name"].lower(), 2.0) for r in rows(d, "candidates", ["name"])]
    total = 0.0
    for r in rows(d, "tweets", ["text_raw"]):
        low = r["text_raw"].lower()
        total += sum(weight * low.count(w) for w, weight in words) * 1000 / max(1, len(low))
    return int(total)


def contains_pii(d: str) -> int:
    compiled = [re.compile(p) for p in PATTERNS.values()]
    return sum(any(p.search(r["text_raw"]) for p in compiled) for r in rows(d, "tweets", ["text_raw"]))


def redact_all(d: str) -> int:
    n = 0
    for r in rows(d, "tweets", ["text_raw"]):
        text = r["text_raw"]
        for k, _, a, b, _ in reversed(settle(spans_in(text), "merge")):
            text = text[:a] + f"[{k}]" + text[b:]
        n += len(text)
    return n


def gold_majority(d: str) -> int:
    items: dict = defaultdict(Counter)
    for r in rows(d, "annotations", ["item_id", "political_leaning", "sentiment"]):
        for f in ("political_leaning", "sentiment"):
            if r[f]:
                items[r["item_id"]][f, r[f].strip().upper().replace("-", "_").replace(" ", "_")] += 1
    return len(items)


def by_class_undersample(d: str) -> int:
    groups: dict = defaultdict(list)
    for r in rows(d, "documents", ["doc_id", "lang"]):
        groups[r["lang"]].append((hashlib.md5(f"42|{r['doc_id']}".encode()).hexdigest(), r["doc_id"]))
    return sum(len(sorted(v)[:20]) for v in groups.values())


def merge_by_id(d: str) -> int:
    first: dict = {}
    for r in sorted(rows(d, "tweets", ["tweet_id", "text_raw", "collected_at", "author_id_hash"]), key=lambda r: r["collected_at"]):
        first.setdefault(r["tweet_id"], r)
    return len(first)


def store_query(d: str) -> int:
    return sum(1 for r in rows(d, "tweets", ["tweet_id", "created_at", "political_score", "lang"]) if r["created_at"] and r["lang"] == "en" and r["political_score"] is not None and r["political_score"] >= 0.5)


def user_counters(d: str) -> int:
    seen: dict = {}
    for r in rows(d, "tweets", ["author_id_hash", "collected_at"]):
        n, a, b = seen.get(r["author_id_hash"], (0, r["collected_at"], r["collected_at"]))
        seen[r["author_id_hash"]] = n + 1, min(a, r["collected_at"]), max(b, r["collected_at"])
    return len(seen)


LOOPS = (clean_pipeline, extract_hashtags, keyword_score, contains_pii, redact_all, gold_majority, by_class_undersample, merge_by_id, store_query, user_counters)


def main(folder: str = "/root/testdata/sf0.1") -> None:
    seconds = {}
    for loop in LOOPS:
        took = []
        for _ in range(3):
            t = time.time()
            loop(folder)
            took.append(time.time() - t)
        seconds[loop.__name__] = round(statistics.median(took), 3)
    print(json.dumps({"metric": "sum of loop seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(folder).name}))


if __name__ == "__main__":
    main(*sys.argv[1:])
