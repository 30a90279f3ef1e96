"""The training-data operators of the core against brute force, on small fixtures with awkward rows."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorasift.llm import messages as M
from agorasift.llm import names as N
from agorasift.llm import capping, consensus, cross_split, grouped_split, name_links
from agorasift.llm.components import components


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


# ---------------------------------------------------------------- capping


def cap_rows(spark, rows):
    return spark.createDataFrame(rows, "tweet_id string, author string, q double, month string, extra int")


def kept_brute(rows, cap):
    by = defaultdict(list)
    for i, a, q, _, _ in rows:
        if a is not None:
            by[a].append((q is None or q != q, -(q if q is not None and q == q else 0.0), i))
    out = {i for v in by.values() for _, _, i in sorted(v)[:cap]}
    return out | {i for i, a, *_ in rows if a is None}


@pytest.mark.parametrize("cap", [1, 3, 30])
def test_cap(spark, cap):
    rnd = random.Random(1)
    rows = [(f"t{i}", rnd.choice(["hot", "hot", "hot", "b", "c", None]), rnd.choice([None, float("nan"), 0.5, 0.5, -1.0, 0.9]), "m", 1) for i in range(300)]
    df = cap_rows(spark, rows)
    got = capping.cap_contributors(df, id_col="tweet_id", contributor="author", quality="q", cap=cap)
    assert {r["tweet_id"] for r in got.collect()} == kept_brute(rows, cap)
    assert {r["tweet_id"] for r in capping.dropped(df, got, "tweet_id").collect()} == {r[0] for r in rows} - kept_brute(rows, cap)


def test_cap_share_and_strata(spark):
    rows = [(f"t{i}", "a", float(i), "m1" if i < 8 else "m2", 0) for i in range(10)] + [("u", "b", 1.0, None, 0)]
    df = cap_rows(spark, rows)
    got = capping.cap_contributors(df, id_col="tweet_id", contributor="author", quality="q", cap=5, strata=F.col("month")).collect()
    n = defaultdict(int)
    for r in got:
        n[r["author"], r["stratum"]] += 1
    assert dict(n) == {("a", "m1"): 4, ("a", "m2"): 1, ("b", None): 1}
    equal = capping.cap_contributors(df, id_col="tweet_id", contributor="author", quality="q", cap=6, strata=F.col("month"), weighting="equal").where("author = 'a'")
    assert {r["stratum"]: r["count"] for r in equal.groupBy("stratum").count().collect()} == {"m1": 4, "m2": 2}  # spare slots are passed on
    assert capping.cap_contributors(df, id_col="tweet_id", contributor="author", quality="q", max_share=0.3).where("author = 'a'").count() == 3
    assert capping.cap_contributors(df.limit(0), id_col="tweet_id", contributor="author", quality="q", cap=5).count() == 0
    with pytest.raises(ValueError):
        capping.cap_contributors(df, id_col="tweet_id", contributor="author", quality="q")


# ---------------------------------------------------------------- components and splits


def roots_brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b:
            up[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(up) if any(x in e and e[0] != e[1] and all(e) for e in edges)}


def test_components(spark):
    rnd = random.Random(3)
    chain = [(f"c{i:02}", f"c{i + 1:02}") for i in range(20)]
    star = [("hub", f"s{i}") for i in range(30)]
    edges = chain + star + [(f"r{rnd.randrange(40)}", f"r{rnd.randrange(40)}") for _ in range(30)] + [("x", "x"), (None, "y"), ("s1", "hub")]
    labels, forest = components(spark.createDataFrame(edges, "a string, b string"))
    got = {r["node"]: r["root"] for r in labels.collect()}
    assert got == roots_brute(edges)
    assert forest.distinct().count() == len(got) - len(set(got.values()))
    empty, _ = components(spark.createDataFrame([], "a string, b string"))
    assert empty.count() == 0


def tables(spark):
    tweets = [(f"t{i}", f"u{i % 12}", day(i)) for i in range(240)] + [("t0", "u5", day(1)), ("lone", None, None), (None, "u1", None), ("t1", "u1", day(2))]
    meta = [("u1", '{"renamed_from": "ghost"}'), ("u2", '{"also_posts_as": ["ghost"]}'), ("u3", '{"operator": " ORG-1 "}'), ("u4", '{"team": {"operator": "org-1", "seats": 2}}'), ("u6", '{"operator": "unknown"}'), ("u7", '{"operator": "unknown", "follows": ["u8"]}'), ("u9", "no json"), ("u10", None)]
    return spark.createDataFrame(tweets, "tweet_id string, author_id_hash string, collected_at timestamp"), spark.createDataFrame(meta, "user_id_hash string, metadata string")


def test_author_groups(spark):
    tweets, users = tables(spark)
    groups, _ = grouped_split.author_groups(tweets, users)
    assert {r["author_id_hash"]: r["group_key"] for r in groups.where("members > 1").collect()} == {"u0": "u0", "u5": "u0", "u1": "u1", "u2": "u1", "u3": "u3", "u4": "u3"}


def test_split_together(spark):
    tweets, users = tables(spark)
    rows = grouped_split.split_together(tweets, users).collect()
    assert len(rows) == len({r["tweet_id"] for r in rows}) == 241
    by = defaultdict(set)
    for r in rows:
        by[r["group_key"]].add(r["split"])
    assert all(len(v) == 1 for v in by.values())
    many = spark.createDataFrame([(f"g{i}", 1 + (i % 7) * (i % 3)) for i in range(3000)], "g string, n int")
    dealt = many.join(grouped_split.deal(many, {"train": 0.8, "validation": 0.1, "test": 0.1}), "g")
    share = {r["split"]: r["n"] for r in dealt.groupBy("split").agg(F.sum("n").alias("n")).collect()}
    total = sum(share.values())
    assert abs(share["train"] / total - 0.8) < 0.01 and abs(share["test"] / total - 0.1) < 0.01
    assert grouped_split.split_together(tweets.limit(0), users.limit(0)).count() == 0


# ---------------------------------------------------------------- consensus


ANN = "item_id string, annotator_id string, political_leaning string, sentiment string, created_at timestamp, seq long, extra string"


@pytest.mark.filterwarnings("ignore:expectation")
def test_consensus_beats_the_majority(spark):
    rnd = random.Random(5)
    rows, truth, k = [], {}, 0
    for i in range(300):
        t = rnd.choice(consensus.LEANINGS)
        truth[f"i{i}"] = t
        for a in ("good1", "good2"):
            rows.append((f"i{i}", a, t if rnd.random() < 0.93 else rnd.choice(consensus.LEANINGS), None, day(k), k, "x"))
            k += 1
        for a in ("always1", "always2"):  # outvote the good ones on their favourite
            rows.append((f"i{i}", a, " center-left ", None, day(k), k, "x"))
            k += 1
        rows.append((f"i{i}", "chance", rnd.choice(consensus.LEANINGS), None, day(k), k, "x"))
        k += 1
    rows.append(("i0", "good1", "UNKNOWN", None, day(-5), k, "x"))  # an older draft
    rows += [("solo", "good1", "LEFT", None, day(1), k + 1, "x"), (None, "good1", "LEFT", None, None, k + 2, "x"), ("blank", "good1", None, None, None, k + 3, "x"), ("blank", "good2", "odd", None, None, k + 4, "x")]
    rows.append(rows[3])  # delivered twice
    labels, per = consensus.consensus(spark.createDataFrame(rows, ANN))
    got = {r["item_id"]: r["label"] for r in labels.collect()}
    assert "solo" not in got and "blank" not in got
    assert np.mean([got[i] == t for i, t in truth.items()]) > 0.9
    skill = {r["annotator_id"]: r["skill"] for r in per.collect()}
    assert min(skill["good1"], skill["good2"]) > 0.6 and max(skill["always1"], skill["always2"], skill["chance"]) < 0.25
    # a round by joins gives the counts of a round by broadcast
    current = consensus.current_annotations(spark.createDataFrame(rows, ANN))
    names = ["always1", "always2", "chance", "good1", "good2"]
    items, sums = consensus._packed(current, names), consensus._sums()
    c0 = consensus._pass(items, None, 5, sums)
    c1 = consensus._pass(items, [consensus._logs(x, 6.0) for x in c0], 5, sums)[0]
    _, conf, _ = consensus.estimate(consensus.label_rows(current), passes=1)
    want = consensus._logs(c1, 6.0)[0]
    for r in conf.where("kind = 'political_leaning'").collect():
        assert np.allclose([r[f"c{k}"] for k in range(7)], want[names.index(r["annotator_id"]), r["l"]], atol=1e-6)


def test_agreement_and_nothing(spark):
    rows = [("1", "a", "LEFT", None, day(0), 0, ""), ("1", "b", "left", None, day(1), 1, ""), ("2", "a", "RIGHT", None, day(2), 2, ""), ("2", "b", "LEFT", None, day(3), 3, "")]
    got = {r["item_id"]: r for r in consensus.item_agreement(spark.createDataFrame(rows, ANN)).collect()}
    assert got["1"]["observed"] == 1.0 and got["2"]["observed"] == 0.0 and abs(got["1"]["expected"] - 10 / 16) < 1e-9
    labels, per = consensus.consensus(spark.createDataFrame([], ANN))
    assert labels.count() == 0 and per.count() == 0


# ---------------------------------------------------------------- cross-split overlaps


BASE = "The mayor of Ashwell found 379 errors in the audit report before the March recess and nobody in Corton believes the rushed story"


@pytest.mark.parametrize(
    "other, same",
    [
        (BASE, True), (BASE.upper(), True), ("RT @x_1: " + BASE + " #Tag https://a.example/1", True), (BASE.replace("errors", "erorrs").replace("report", "reportt"), True),
        (BASE[:90] + "…", True), ("Again: " + BASE + "!! (via @y)", True), (BASE.replace("379", "412"), False), (BASE.replace("Ashwell", "Marlow").replace("Corton", "Denby"), False),
        ("A completely different message about another thing in this town today", False), ("", False),
    ],
)
def test_same_message(other, same):
    (a, ca), (b, cb) = M.core(BASE), M.core(other)
    assert (M.same_message(a, b, ca, cb) > 0) == same == (M.same_message(b, a, cb, ca) > 0)


def test_overlaps(spark):
    texts = {"a": BASE, "b": "RT @q: " + BASE, "c": BASE.replace("errors", "erors"), "d": BASE.replace("379", "412"), "e": "", "f": "@only #tags https://x.example", "g": None, "h": "Short note here", "i": "short note here!"}
    split = {"a": "train", "b": "test", "c": "validation", "d": "test", "e": "train", "f": "test", "g": "test", "h": "train", "i": "test", "z": "train"}
    rows = [(k, v, "q", 1) for k, v in texts.items()] + [("a", BASE, "q", 2), ("n", BASE, "q", 3), (None, BASE, "q", 4)]
    tweets = spark.createDataFrame(rows, "tweet_id string, text_raw string, collection_query string, split int")
    splits = spark.createDataFrame([*split.items(), ("a", "train"), ("b", None), (None, "test")], "tweet_id string, split string")
    got = {(r["tweet_id_a"], r["tweet_id_b"]) for r in cross_split.found(tweets, splits).collect()}
    assert got == {("a", "b"), ("a", "c"), ("h", "i")}
    rep = {r["split"]: (r["tweets"], r["leaked"], r["pairs"]) for r in cross_split.report(tweets, splits).collect()}
    assert rep == {"test": (5, 2, 2), "validation": (1, 1, 1)}
    assert cross_split.found(tweets.limit(0), splits).count() == 0 and cross_split.found(tweets, splits.limit(0)).count() == 0


def test_short_copies_are_found(spark):
    pair = ("council votes tonight on the northern river levy plan", "council votes tonight on the northern bridge levy plan")
    more = "so council votes tonight on the northern river levy plan"
    rows = [("a", pair[0], "q"), ("b", pair[1], "q"), ("c", more, "q"), ("d", "council votes tonight on quite another thing again today", "q"), ("a2", pair[0], "p")]
    tweets = spark.createDataFrame(rows, "tweet_id string, text_raw string, collection_query string")
    splits = spark.createDataFrame([("a", "train"), ("a2", "train"), ("b", "test"), ("c", "test"), ("d", "test"), ("a2", "test")], "tweet_id string, split string")
    brute = {(h, t) for h, x in (("b", pair[1]), ("c", more), ("d", rows[3][1]), ("a2", pair[0])) for t in ("a", "a2") if h != t and M.same_message(M.core(x)[0], M.core(pair[0])[0]) > 0}
    assert {("b", "a"), ("c", "a"), ("a2", "a")} <= brute
    assert {(r["held_id"], r["train_id"]) for r in cross_split.overlaps(tweets, splits).collect()} == brute
    rep = {(r["split"], r["collection_query"]): (r["tweets"], r["leaked"], r["pairs"]) for r in cross_split.report(tweets, splits).collect()}
    assert rep == {("test", "q"): (3, 2, 4), ("test", "p"): (1, 1, 1)}
    got = {(r["tweet_id"], r["held"]): (r["cls"], r["links"]) for r in cross_split.classes(tweets, splits).collect()}
    assert got["a", False][0] == got["a2", True][0] and got["a", False][1] == 2 and got["b", True][1] == 1 and got["d", True][1] == 0


def test_hot_message_costs_few_blocks():
    words = [BASE.casefold().split()] * 3
    whole, blocks = M.codes([*words, [], ["one"]])
    assert whole[0] == whole[1] and sorted(blocks[0]) == sorted(blocks[2]) and blocks[3] == [] and len(blocks[4]) == 1


# ---------------------------------------------------------------- names


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Saldnehope, Nicholas", "Nick Saldnehope", True), ("DR. JOSEPH VICKLORRICK", "Vicklorrick, Joseph", True), ("M.M. Jarvmowhit", "Mr. Matthew Jarvmowhit", True), ("Walter Barrrocott", "Waltre Barrrocott", True),
        ("Aldmadorf Seed, Assn", "ALDMADORF SEED ASSOCIATION", True), ("Penntofell + Kandnokin Timber Bros.", "Penntofell and Kandnokin Timber Brothers", True),
        ("Philippa Ilkvipage Jr", "Philippa Ilkvipage Sr", False), ("Christina Bradsircroft", "Nicholas Bradsircroft", False), ("Macksoland Timber Company", "Macksoland Printing Company", False), ("T. Dagmestein", "R. Dagmestein", False),
    ],
)
def test_compare(a, b, same):
    pa, pb = N.parse(a), N.parse(b)
    key = next((x, y) for x in sorted(pa[0], key=len, reverse=True) for y in pb[0] if x == y or N.typo(x, y))
    assert (N.compare(pa, pb, *key, {})[0] >= name_links.SURE) == same


def test_name_links(spark):
    rows = [
        ("1", "Nicholas Saldnehope", "Wexhaven", "FL"), ("2", "SALDNEHOPE, NICK", " WEXHAVEN ", "FL"), ("3", "Nichoals Saldnehope", "Wexhaven", "FL"), ("4", "Nicholas Saldnehope", "Other Town", "FL"), ("5", "Pamela Saldnehope", "Wexhaven", "FL"),
        ("6", "N. Saldnehope", None, "TX"), ("7", "Philippa Ilk Jr", "Calmoor", "MS"), ("8", "Philippa Ilk Sr", "Calmoor", "MS"), ("9", "P. Ilk Jr", "Calmoor", "MS"), ("10", "Nick  Saldnehope", None, "FL"), ("1", "Nicholas Saldnehope", "Wexhaven", "FL"),
        ("11", None, "x", "y"), ("12", "", None, None), ("13", "???", None, None), (None, "Nick Saldnehope", "Wexhaven", "FL"), ("14", "Kolb Seed Co", "Calmoor", "MS"), ("15", "The Kolb Seed Company", "Calmoor", "MS"), ("16", "Kolb Sedd Company", "Calmoor", None),
        *[(f"h{i}", "Great Conduit Fund", "Big", "DE") for i in range(200)],
    ]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "contribution_id string, contributor_name string, contributor_city string, contributor_state string, cls double")
    got = {(r["contribution_id_a"], r["contribution_id_b"]) for r in name_links.found(df).collect()}
    # 10 fits two towns, so it joins neither
    want = {("1", "2"), ("1", "3"), ("2", "3"), ("7", "9"), ("14", "15"), ("14", "16"), ("15", "16")}
    assert got == want
    assert name_links.found(df.limit(0)).count() == 0


def test_common_surnames_are_linked(spark):
    rows = [
        ("1", "Smith, Ted", "Wexhaven", "FL"), ("2", "Smith, Theodore", "Wexhaven", "FL"), ("3", "Smith, Zebulon", "Calmoor", "MS"), ("4", "Smith, Z.", "Calmoor", "MS"), ("5", "Smith, Xaver", "Calmoor", "MS"),
        *[(f"s{i}", f"Smith, Theodore {chr(97 + i % 26)}{chr(97 + i // 26)}kolb", f"Town {i}", "DE") for i in range(80)],
    ]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "contribution_id string, contributor_name string, contributor_city string, contributor_state string, cls double")
    got = {(r["contribution_id_a"], r["contribution_id_b"]) for r in name_links.found(df).collect()}
    assert got == {("1", "2"), ("3", "4")}


def test_may_agree_drops_no_pair(spark):
    names = ["Nicholas Saldnehope", "Nick Saldnehope", "SALDNEHOPE, N.", "Nichoals Saldnehope", "Pamela Saldnehope", "Jonathon Ilkvipage", "Jon Ilkvipage", "Ted Kolb", "Theodore Kolb", "Ed Kolb", "Kolb, T", "Kolb Seed Co", "Kolb Sedd Company", "Kolb Print Co", "Philippa Ilk Jr", "Philippa Ilk Sr", "Mary Ann Kolb", "Ann Kolb", "Katherine Kolb", "Catherin Kolb", "Kate Kolb"]
    forms = [N.parse(n) for n in names]
    rows = [(i, j, (*x, N.families(x[0])), (*y, N.families(y[0]))) for i, x in enumerate(forms) for j, y in enumerate(forms) if i != j]
    kind = "struct<words:array<string>,initials:array<string>,suffix:string,org:boolean,family:array<string>>"
    kept = {(r["a"], r["b"]) for r in spark.createDataFrame(rows, f"a int, b int, fa {kind}, fb {kind}").where(name_links.may_agree("fa", "fb")).collect()}
    for i, j, x, y in rows:
        keys = [(v, w) for v in x[0] for w in y[0] if v == w or N.typo(v, w)]
        if any(N.compare(x[:4], y[:4], v, w, {})[0] >= name_links.SURE for v, w in keys):
            assert (i, j) in kept, (names[i], names[j])
    assert len(kept) < len(rows) / 2


def test_a_hub_and_a_chain(spark, monkeypatch):
    from agorasift.functions import joins

    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    edges = [("hub", f"leaf{i}") for i in range(60)] + [(f"c{i:02}", f"c{i + 1:02}") for i in range(12)] + [("c03", "c03"), (None, "x"), ("hub", "leaf1")]
    labels, forest = components(spark.createDataFrame(edges, "a string, b string"))
    got = {r["node"]: r["root"] for r in labels.collect()}
    assert got == {"hub": "hub", **{f"leaf{i}": "hub" for i in range(60)}, **{f"c{i:02}": "c00" for i in range(13)}}
    assert forest.count() == len(got) - 2


def test_a_hot_place_is_contracted_by_joins(spark):
    links = spark.createDataFrame([(i, i + 1, "hot") for i in range(30)] + [(100, 101, "x"), (102, 101, "x"), (200, 201, "y")], "a long, b long, k string")
    cold, hot = ({(r["node"], r["root"]) for r in name_links.place_components(links, n).collect()} for n in (1000, 5))
    assert cold == hot == {(i, 0) for i in range(31)} | {(i, 100) for i in (100, 101, 102)} | {(200, 200), (201, 200)}


def test_similar_words_like_brute_force(spark):
    rnd = random.Random(2)
    base = ["macksoland", "holbrishire", "gantdastrom", "seed", "kolb", "penntofell"]
    words = set(base)
    for w in base:
        for _ in range(4):
            i = rnd.randrange(len(w) - 1)
            words |= {w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "x" + w[i + 1 :]}
    df = spark.createDataFrame([("k", w, True) for w in words if len(w) > 6], "k string, w string, asks boolean")
    got = {(r["wa"], r["wb"]) for r in name_links.similar_words(df).collect()}
    lost = {(a, b) for a in words for b in words if len(a) > 6 and len(b) > 6 and a != b and N.distance(a, b, 1) <= 1} - got
    assert not lost


def test_common_phrases_store_no_pairs_of_codes(spark, monkeypatch):
    """Texts that share a phrase and little else have near codes; their pairs must end in the join (F1)."""
    phrase = "several residents demanded another hearing before winter closing ceremony"
    r = random.Random(5)
    texts = [f"{phrase} " + " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(10)) for _ in range(60)]
    rows = [(f"t{i:02}", t) for i, t in enumerate(texts)] + [("copy", texts[0].replace("winter", "wintr"))]
    tweets = spark.createDataFrame(rows, "tweet_id string, text_raw string")
    splits = spark.createDataFrame([(k, "test" if i % 2 else "train") for i, (k, _) in enumerate(rows[:-1])] + [("copy", "test")], "tweet_id string, split string")
    stored, cut = [], cross_split.cut
    monkeypatch.setattr(cross_split, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    assert [tuple(r) for r in cross_split.found(tweets, splits).collect()] == [("copy", "t00")]
    pairs = [df.count() for df in stored if set(df.columns) == {"ca", "cb"}]
    assert pairs and sum(pairs) <= 60  # of 900, most of which lie within the radius


def test_common_given_names_end_in_the_join(spark):
    """Classes that share a given name and nothing else are no stored pairs (F2)."""
    names = [["john", w] for w in ("aldwick", "barstow", "cormley", "dunmere", "eastlake", "farrow", "gadsby")] + [["farow", "john"]]
    rows = [(i, w, "cs|A|B", True, (words, "", False, ["john"])) for i, words in enumerate(names) for w in words]
    side = spark.createDataFrame(rows, "cls long, w string, k string, loose boolean, f struct<words: array<string>, suffix: string, org: boolean, family: array<string>>")
    words = sorted({w for x in names for w in x})
    alike = spark.createDataFrame([("cs|A|B", w, w) for w in words] + [("cs|A|B", "farrow", "farow"), ("cs|A|B", "farow", "farrow")], "k string, wa string, wb string")
    got = sorted(tuple(r) for r in name_links.may_link(alike, side, side).select("a", "b").collect())
    assert got == [(5, 7), (7, 5)], got
