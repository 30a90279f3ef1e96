import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from agorasift import config, streaming
from agorasift.operators import annotate as A
from agorasift.operators import retention as R
from agorasift.operators import sampling as S
from agorasift.sources import catalog as CA
from agorasift.sources import finance, paged, ratelimit, store

ANN = "item_id string, annotator_id string, political_leaning string, sentiment string, topics array<string>, is_political boolean, confidence double, created_at timestamp, seq long"


def ann(spark, rows):
    return spark.createDataFrame([(i, a, l, s, t, p, c, None, k) for k, (i, a, l, s, t, p, c) in enumerate(rows)], ANN)


def test_gold(spark):
    df = ann(spark, [("1", "a", "left", "POSITIVE", ["economy"], True, 1.0), ("1", "b", " LEFT", None, ["healthcare"], True, 1.0), ("1", "c", "RIGHT", None, ["immigration"], False, 1.0), ("2", "a", "LEFT", None, None, True, 1.0), ("2", "b", "RIGHT", None, None, False, 0.5)])
    m = {r["item_id"]: r for r in A.gold(df).collect()}
    assert m["1"]["political_leaning"] == "LEFT" and m["1"]["topics"] == ["economy", "healthcare", "immigration"] and m["1"]["annotation_count"] == 3
    assert m["2"]["political_leaning"] == "LEFT"  # the first seen wins a tie
    assert abs({r["item_id"]: r for r in A.gold(df, "weighted").collect()}["2"]["political_leaning"] + 1 / 3) < 1e-9
    assert {r["item_id"]: r for r in A.gold(df, "average").collect()}["2"]["political_leaning"] == 0
    with pytest.raises(ValueError):
        A.gold(df, "median")


def test_agreement(spark):
    same = ann(spark, [("1", "a", "LEFT", None, None, True, 1.0), ("1", "b", "LEFT", None, None, True, 1.0)])
    other = ann(spark, [("1", "a", "LEFT", None, None, True, 1.0), ("1", "b", "RIGHT", None, None, True, 1.0), ("2", "c", "LEFT", None, None, None, 1.0)])
    assert A.agreement(same).first()["political_leaning_agreement"] == 1.0
    row = A.agreement(other).first()
    assert row["political_leaning_agreement"] == 0.0 and row["is_political_agreement"] == 1.0 and row["items_with_multiple_annotations"] == 1
    assert A.agreement(same, ["a"]).first()["political_leaning_agreement"] is None
    assert A.annotation_stats(other).first()["per_item"] == 1.5


def test_by_class(spark):
    df = spark.createDataFrame([(i, "big" if i < 90 else "small", ["x", "y"] if i % 2 else ["x"]) for i in range(100)] + [(100, None, None)], "id int, c string, l array<string>")
    under = S.by_class(df, "c", "id")
    assert {r["class"]: r["count"] for r in under.groupBy("class").count().collect()} == {"big": 10, "small": 10}
    assert set(map(tuple, under.select("id").collect())) == set(map(tuple, S.by_class(df.repartition(7), "c", "id").select("id").collect()))
    over = S.by_class(df, "c", "id", per_class=30, strategy="oversample")
    assert {r["class"]: r["count"] for r in over.groupBy("class").count().collect()} == {"big": 30, "small": 30}
    assert over.where("class = 'small'").select("id").distinct().count() <= 10
    assert {r["class"] for r in S.by_class(df, "l", "id").collect()} == {"x", "y"}
    assert S.by_class(df.where("c is null"), "c", "id").count() == 0


def test_split(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(100)], "id int, s string")
    n = {r["split"]: r["count"] for r in S.split(df, "id", (0.29, 0.3, 0.41)).groupBy("split").count().collect()}
    assert n == {"train": int(100 * 0.29), "validation": 30, "test": 42}
    assert S.split(df, "id", stratify="s").count() == 100 and S.split(df.limit(0), "id").count() == 0
    with pytest.raises(ValueError):
        S.split(df, "id", (0.5, 0.1, 0.1))


def test_sample_merge_political(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "id int")
    assert S.sample(df, 5, "id").count() == 5 and S.sample(df, 50, "id").count() == 20
    a, b = spark.createDataFrame([("1", "x"), (None, "n1")], "id string, v string"), spark.createDataFrame([("1", "y", 1), ("2", "z", 2), (None, "n2", 3)], "id string, v string, w int")
    got = {(r["id"], r["v"]) for r in S.merge([a, b]).collect()}
    assert got == {("1", "x"), (None, "n1"), ("2", "z")}
    with pytest.raises(ValueError):
        S.merge([a])
    t = spark.createDataFrame([(1, "we love LEFTIES"), (2, "rightists"), (3, "lefties and rightists"), (4, "none"), (5, None)], "id int, text string")
    assert {r["id"]: r["political_label"] for r in S.political_balance(t, ["lefties"], ["rightists"], "id", neutral=True).collect()} == {1: "left", 2: "right", 4: "neutral"}


def test_store(spark, tmp_path):
    raw = spark.createDataFrame([("1", "hi", "2024-01-15T10:00:00Z", "u"), ("2", "ho", "not a date", "v")], "id string, text string, created_at string, author_id string")
    rows = store.normalize(raw, "q", F.lit("2024-02-03").cast("timestamp"), F.sha2("author_id", 256))
    st = store.TweetStore(spark, str(tmp_path / "s"))
    st.append(rows)
    st.append(rows)
    assert (tmp_path / "s" / "year=2024" / "month=02").exists() and st.read().count() == 4
    assert st.query(query="q", start="2024-01-01", limit=0).count() == 2 and st.query(lang="en").count() == 0
    assert st.stats().first()["rows"] == 4 and st.validate()["valid"] and sum(len(b) for b in st.batches(size=3)) == 4
    assert st.compact() == 4 and len(st.files()) == 1 and st.read().count() == 4
    assert st.delete(st.files()[0])
    with pytest.raises(ValueError):
        st.append(rows.limit(0))


def test_items_files(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps({"metadata": {}, "items": [{"id": "1", "t": ["x"]}]}))
    df = store.read_items(spark, str(p))
    assert df.first()["id"] == "1"
    q = tmp_path / "b.json"
    q.write_text(json.dumps([{"id": "2"}]))
    assert store.read_items(spark, str(q)).first()["id"] == "2"
    store.write_items(df, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["t"] == '["x"]'
    store.write_items(df, str(tmp_path / "d"), "json", {"k": 1})
    assert json.loads((tmp_path / "d" / "_metadata.json").read_text()) == {"k": 1}


def test_catalog(spark):
    ev = spark.createDataFrame([(1, 1, "pending", '{"a": "1", "b": "1"}', False), (1, 2, "done", '{"b": "2"}', False), (2, 1, "pending", None, False), (2, 2, "pending", None, True)], "id int, seq int, status string, metadata string, gone boolean")
    assert [r["status"] for r in CA.latest(ev, "id", ["seq"], "gone").collect()] == ["done"]
    assert json.loads(CA.merged_metadata(ev, "id", ["seq"]).first()["metadata"]) == {"a": "1", "b": "2"}
    u = CA.user_counters(spark.createDataFrame([("u", dt.datetime(2024, 1, 2)), ("u", dt.datetime(2024, 1, 1)), (None, None)], "u string, ts timestamp"), "u", "ts")
    assert u.first()["tweet_count"] == 2 and CA.user_stats(u).first()["avg_tweets"] == 2.0
    assert CA.user_stats(u.limit(0)).first()["tweets"] == 0


def test_catalog_log(spark, tmp_path):
    c = CA.Catalog(spark, str(tmp_path / "log"))
    a, b = c.create_collection("one", "q1", metadata={"x": 1, "y": 2}), c.create_collection("two", "q2")
    assert a != b and c.update_collection(a, 7, "completed", {"y": 3}) and not c.update_collection(a) and not c.update_collection(999, 1)
    c.save_checkpoint(a, "t1", "tok", 5, {"k": 1})
    c.save_checkpoint(a, "t2", None, 9)
    get = lambda t: {r["key"]: r["fields"] for r in CA.state(c.events(), t).collect()}
    one = get("collections")[str(a)]
    assert one["status"] == "completed" and one["tweet_count"] == "7" and one["metadata.x"] == "1" and one["metadata.y"] == "3" and one["name"] == "one"
    assert get("checkpoints")[str(a)] == {"last_tweet_id": "t2", "next_token": None, "items_collected": "9"}
    c.log_query("q1", "search", 3)
    c.log_query("q1", "search", None, False, "429")
    for u in ("u", "u", "v"):
        c.track_user(u)
    assert c.stats().first().asDict() == {"collections": 2, "completed": 1, "collected": 7, "users": 2, "queries": 2}
    assert c.delete_collection(a) and not c.delete_collection(a) and not c.delete_checkpoint(a)
    assert set(get("collections")) == {str(b)} and get("checkpoints") == {}
    again = CA.Catalog(spark, str(tmp_path / "log"))
    assert set(r["key"] for r in CA.state(again.events(), "collections").collect()) == {str(b)}
    again._commit([("put", "schema", "version", {"version": 99})])
    with pytest.raises(ValueError):
        CA.Catalog(spark, str(tmp_path / "log"))


CALLS: dict = {}


def flaky(query, token, options):
    """Recorded pages, of which each one is refused once."""
    from agorasift.sources.ratelimit import Refused

    key = (options["path"], query, token)
    CALLS[key] = CALLS.get(key, 0) + 1
    if CALLS[key] == 1:
        raise Refused("429", 0.0)
    return paged.recorded_pages(query, token, options)


def test_sources_retry_resume_and_read_all_queries(spark, tmp_path):
    page = lambda k: {"data": [{"id": str(k), "text": f"t{k}"}]}
    f = tmp_path / "pages.json"
    f.write_text(json.dumps({"q1": [page(1), page(2)], "q2": [page(4)]}))
    opts = {"path": str(f), "queries": '["q1", "q2", "q1"]', "fetch": f"{__name__}:flaky", "resume": str(tmp_path / "pages"), "endpoint": "search_recent", "tier": "pro"}
    read = lambda: sorted(r[0] for p in paged._Reader(opts).partitions() for r in paged._Reader(opts).read(p))
    assert read() == ["1", "2", "4"]
    calls = dict(CALLS)
    assert read() == ["1", "2", "4"] and calls == CALLS and set(CALLS.values()) == {2}  # finished pages are not asked for again
    live = paged._Stream(opts | {"resume": str(tmp_path / "more")})
    rows, at = live.read(live.initialOffset())
    assert sorted(r[0] for r in rows) == ["1", "4"]
    rows, end = live.read(at)
    assert [r[0] for r in rows] == ["2"] and end["tokens"] == ["end", "end"]
    assert sorted(r[0] for r in live.readBetweenOffsets(live.initialOffset(), end)) == ["1", "2", "4"]
    with pytest.raises(ValueError):
        paged._Stream({k: v for k, v in opts.items() if k != "resume"})
    assert paged.date_ranges("2024-01-01", "2024-02-05", 14) == [("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-01-29"), ("2024-01-29", "2024-02-05")]
    assert paged.archive_texts(["a"], "2024-01-01", "2024-01-03", 1) == ["a since:2024-01-01 until:2024-01-02", "a since:2024-01-02 until:2024-01-03"]
    g = tmp_path / "f.json"
    g.write_text(json.dumps({"candidates": [[{"candidate_id": "A"}], [{"candidate_id": "B"}]]}))
    s = finance._Stream({"fetch": "agorasift.sources.finance:recorded_finance", "path": str(g)}, "candidates")
    rows, at = s.read(s.initialOffset())
    assert [r[0] for r in rows] == ["A"] and [r[0] for r in s.readBetweenOffsets({"page": 0}, {"page": 2})] == ["A", "B"]


def test_merge_keeps_the_first_row(spark, tmp_path):
    rows = [(str(i % 15), i) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, v int").coalesce(1)
    df.write.parquet(str(tmp_path / "a"))
    for x in (df, spark.read.parquet(str(tmp_path / "a"))):
        assert {r["id"]: r["v"] for r in S.merge([x, df]).collect()} == {str(i): i for i in range(15)}


def test_a_broken_compaction_is_finished(spark, tmp_path):
    rows = store.normalize(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, text string"), "q")
    s = store.TweetStore(spark, str(tmp_path / "s"))
    assert s.append(rows) == 2 and s.append(rows) == 4
    v = s.validate()
    assert v["valid"] and v["row_groups"] >= 1 and "parquet" in v["created_by"]
    (tmp_path / "s").rename(tmp_path / "s.1234.old")
    assert store.TweetStore(spark, str(tmp_path / "s")).read().count() == 4


def test_scores_that_are_no_number_match_nothing(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", None), ("c", 0.7), ("d", 0.1)], "tweet_id string, political_score float")
    assert [r["tweet_id"] for r in store.query_tweets(df, min_score=0.5).collect()] == ["c"]


def test_retention(spark):
    df = spark.createDataFrame([("raw", dt.datetime(2024, 1, 1)), ("metadata", dt.datetime(2024, 1, 1)), ("odd", None)], "k string, at timestamp")
    rows = R.expiration(df, "at", F.col("k"), F.lit("2025-01-15").cast("timestamp")).collect()
    assert rows[0]["expired"] and rows[0]["days_remaining"] == 0 and not rows[1]["expired"] and rows[2]["expired"] is None
    req = spark.createDataFrame([("u", dt.datetime(2024, 1, 1), None)], "user string, requested_at timestamp, completed_at timestamp")
    assert R.pending(req, F.lit("2024-03-01").cast("timestamp")).first()["overdue"]
    assert R.without_deleted(spark.createDataFrame([("u",), ("v",), (None,)], "user string"), "user", req).count() == 2


def test_paged_source(spark, tmp_path):
    page = lambda k: {"data": [{"id": str(k), "text": f"t{k}", "author_id": "7", "public_metrics": {"like_count": 3}, "referenced_tweets": [{"type": "quoted"}]}], "includes": {"users": [{"id": "7", "username": "u"}]}}
    f = tmp_path / "pages.json"
    f.write_text(json.dumps({"q1": [page(1), page(2), page(3)], "q2": [page(4)]}))
    spark.dataSource.register(paged.TweetPages)
    load = lambda **o: spark.read.format("tweet_pages").option("path", str(f)).options(**o).load()
    rows = {r["id"]: r for r in load(queries='["q1", "q2"]').collect()}
    assert set(rows) == {"1", "2", "3", "4"} and rows["1"]["author_username"] == "u" and rows["1"]["like_count"] == 3 and rows["1"]["is_quote"] and rows["4"]["query"] == "q2"
    assert load(queries='["q1"]', maxresults="2").count() == 2
    stream = spark.readStream.format("tweet_pages").option("path", str(f)).option("queries", '["q1"]').load()
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
    for _ in range(60):
        q.processAllAvailable()
        if spark.read.schema(paged.TWEET).parquet(str(tmp_path / "o")).count() >= 3:
            break
    q.stop()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["1", "2", "3"]
    assert paged.search_text("a", "2024-01-01", None, "en") == "a since:2024-01-01 lang:en" and paged.user_text("@u", False, False) == "from:u -filter:replies -filter:retweets"


def test_finance(spark, tmp_path):
    f = tmp_path / "f.json"
    f.write_text(json.dumps({"candidates": [[{"candidate_id": "A", "name": "Ann", "election_years": [2020, 2024]}], [{"candidate_id": "B", "name": "Bob", "election_years": [2022]}]]}))
    spark.dataSource.register(finance.FinancePages)
    df = spark.read.format("finance_pages").option("kind", "candidates").option("fetch", "agorasift.sources.finance:recorded_finance").option("path", str(f)).load()
    assert [r["candidate_id"] for r in finance.candidates(df).collect()] == ["A", "B"] and finance.candidates(df, q="bo").count() == 1
    c = spark.createDataFrame([("1", "X", 10.0, "2024-01-02", "C"), ("2", "Y", 20.0, "01/03/2024", "C"), ("2", "Y", 20.0, "01/03/2024", "C"), ("3", "Z", -5.0, None, "C")], "contribution_id string, contributor_name string, contribution_amount double, contribution_date string, committee_id string")
    assert [r["contribution_id"] for r in finance.contributions(c, committee_id="C").collect()] == ["2", "1", "3"]
    assert finance.contributions(c, min_amount=0, period=2024).count() == 2


def test_rate_limits():
    now = [0.0]
    sleep = lambda s: now.__setitem__(0, now[0] + s)
    r = ratelimit.RateLimiter(clock=lambda: now[0], sleep=sleep, jitter=0)
    r.register("e", 2, 10)
    assert r.acquire("e") and r.acquire("e") and not r.acquire("e", blocking=False)
    with pytest.raises(ratelimit.RateLimitExceeded):
        r.acquire("e", timeout=1)
    assert r.acquire("e") and now[0] == 5.0 and [r.backoff("e") for _ in range(3)] == [2.0, 4.0, 8.0]
    w = ratelimit.SlidingWindow(2, 10, lambda: now[0], sleep)
    for _ in range(3):
        w.wait()
    assert now[0] >= 16
    calls = []

    def fail():
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        ratelimit.retrying(fail, sleep=lambda s: None)()
    assert len(calls) == 5 and ratelimit.for_tier("academic").buckets["search_all"].capacity == 300


def test_config(tmp_path):
    f = tmp_path / "c.json"
    f.write_text(json.dumps({"requests": {"tier": "pro", "odd": 1}, "clean.min_length": 3}))
    cfg = config.load([f, tmp_path / "missing"], {"AGORASIFT_REQUESTS_ATTEMPTS": "7", "AGORASIFT_REQUESTS_FETCH": "m:f"})
    assert cfg["requests.tier"] == "pro" and cfg["requests.attempts"] == 7 and cfg["clean.min_length"] == 3 and "requests.odd" not in cfg
    assert config.source_options(cfg) == {"tier": "pro", "attempts": "7", "basedelay": "2.0", "maxdelay": "300.0", "fetch": "m:f"}
    assert [x for x in config.problems(cfg) if "salt" not in x] == [] and any("salt" in x for x in config.problems(cfg))
    assert len(config.problems(cfg | {"requests.tier": "x", "requests.attempts": 0, "privacy.salt": "s"})) == 2


def test_streams(spark, tmp_path):
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1, 1)), ("1", dt.datetime(2024, 1, 1, 2)), ("2", dt.datetime(2024, 1, 2))], "id string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    src = lambda: spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    streaming.append_to(streaming.deduplicated(src(), "id", "ts"), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    q = streaming.users(src(), "id", "ts").writeStream.format("memory").queryName("users_now").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["user_id_hash"]: r["tweet_count"] for r in spark.table("users_now").collect()} == {"1": 2, "2": 1}
