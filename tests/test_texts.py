import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorasift.operators import classify as CL
from agorasift.operators import entities as E
from agorasift.operators import keywords as K
from agorasift.operators import privacy as P
from agorasift.operators import tokens as T

DICT = [
    ("senate", "t", "gov", 1.0), ("healthcare", "t", None, 1.0), ("bill", "t", None, 1.0), ("un", "t", None, 1.0), ("democrat", "p", None, 1.5), ("joe biden", "q", None, 2.0), ("biden", "q", None, 2.0),
    ("white house", "t", None, 1.0), ("house", "t", None, 1.0), ("house of representatives", "t", None, 1.0), ("tax", "t", None, 1.0), ("taxation", "t", None, 1.0), ("climate", "t", None, 1.0), ("climate change", "t", None, 1.0),
]


def brute(text, words):
    occ = sorted((i + len(k), i, k) for k in words for i in range(len(text)) if text.lower().startswith(k, i))
    out, last = [], 0
    for e, s, k in occ:
        if s >= last:
            out.append((s, e, k))
            last = e
    return out


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(DICT, "keyword string, category string, subcategory string, weight double")


@pytest.mark.parametrize(
    "text, found, total",
    [
        ("The Senate passed the new healthcare bill today #Healthcare", ["senate", "healthcare", "bill", "healthcare"], 67.7966),
        ("unemployment in the country under Democrats", ["un", "un", "un", "democrat"], 104.6512),
        ("Joe Biden and the White House", ["joe biden", "white house"], 103.4483),
        ("taxation and climate change", ["tax", "climate"], 74.0741),
        ("Just a regular tweet with no political content", [], 0.0),
    ],
)
def test_match_and_score(spark, words, text, found, total):
    df = K.match(spark.createDataFrame([(text,)], "text string"), words)
    row = df.select("matches", K.score(F.col("matches"), F.col("text")).alias("s")).first()
    assert [m["keyword"].lower() for m in row["matches"]] == found and row["s"]["total_score"] == total


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc d", max_size=40), st.sets(st.text(alphabet="abc d", min_size=1, max_size=4), min_size=1, max_size=8))
def test_automaton_like_brute_force(text, words):
    got = [(m["start"], m["end"], m["keyword"].lower()) for m in K.Automaton([(w, "c", None, 1.0) for w in words]).match(text)]
    assert got == brute(text, words)


def test_fold_agrees(spark, words):
    df = spark.createDataFrame([(1, "unemployment in the country under Democrats"), (2, "Joe Biden and the White House"), (3, "nothing")], "id int, text string")
    a = {r["id"]: [m["keyword"] for m in r["matches"]] for r in K.fold_matches(df, words, "id").collect()}
    assert a == {1: ["un", "un", "un", "democrat"], 2: ["joe biden", "white house"]}


def test_context_and_nulls(spark, words):
    df = K.match(spark.createDataFrame([("x" * 60 + " senate " + "y" * 60,), (None,), ("",)], "text string"), words)
    rows = df.select(K.with_context(F.col("matches"), F.col("text")).alias("c")).collect()
    assert rows[0]["c"][0]["context"].startswith("...x") and rows[0]["c"][0]["context"].endswith("y...")
    assert rows[1]["c"] is None and rows[2]["c"] == []


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"category": "c", "weight": 2.0, "keywords": ["Alpha", "beta"], "subcategories": {"s": ["alpha"]}}))
    (tmp_path / "b.json").write_text(json.dumps({"name": "n", "categories": [{"name": "d", "subcategories": [{"name": "u", "keywords": ["gamma"], "weight": 0.8}]}]}))
    rows = {r["keyword"]: (r["category"], r["subcategory"], r["weight"]) for r in K.load_dictionaries(spark, str(tmp_path)).collect()}
    assert rows == {"alpha": ("c", "s", 2.0), "beta": ("c", None, 2.0), "gamma": ("d", "u", 0.8)}


def test_entities(spark):
    g = spark.createDataFrame([("Ann Lee", "PERSON"), ("Senate", "ORG"), ("Green Party", "ORG")], "name string, label string")
    df = E.recognize(spark.createDataFrame([("Governor Ann Lee met the Senate and the Green Party; Ann Leed stayed",)], "text string"), g)
    s = df.select(E.summary(F.col("entities")).alias("s")).first()["s"]
    assert s["total_entities"] == 3 and s["political_by_type"] == {"politician": ["Ann Lee"], "government_org": ["Senate"], "political_org": ["Green Party"]}


def test_classify(spark, words):
    rows = CL.classify(spark.createDataFrame([(1, "Joe Biden and the White House"), (2, "nothing here")], "id int, text string"), words).orderBy("id").collect()
    assert rows[0]["political"]["is_political"] and rows[0]["political"]["score"] == 1.0 and rows[0]["political"]["topics"] == ["q", "t"]
    assert rows[1]["political"]["confidence"] == 1.0 and not rows[1]["political"]["is_political"]


@pytest.mark.parametrize("text, kinds", [("at john.doe@example.com now", ["EMAIL"]), ("555-123-4567", ["PHONE"]), ("+1-555-123-4567", ["PHONE"]), ("123-45-6789", ["SSN"]), ("192.168.1.100", ["IP_ADDRESS"]), ("The results were announced", [])])
def test_pii(text, kinds):
    assert [s[0] for s in P.spans_in(text)] == kinds


def test_redact(spark):
    df = spark.createDataFrame([("card 4111111111111111 end",), ("Contact john@email.com or call 555-123-4567",), ("hi @bob and @bobby",), (None,), ("",)], "text string")
    keep = [r["redacted"] for r in P.redact(df, overlap="keep").collect()]
    merged = [r["redacted"] for r in P.redact(df).collect()]
    assert merged[0] == "card [REDACTED]_CREDIT_CARD end" and "1111" in keep[0]
    assert merged[1] == "Contact [REDACTED]_EMAIL or call [REDACTED]_PHONE" and merged[2] == "hi @[USER] and @[USER]" and merged[3] is None and merged[4] == ""


def test_hashes(spark):
    df = spark.createDataFrame([("v",)], "v string")
    for algorithm, n in (("sha256", 64), ("sha512", 128), ("md5", 32)):
        assert len(df.select(P.hash_value(F.col("v"), "s", algorithm, None)).first()[0]) == n
    with pytest.raises(ValueError):
        P.hash_value(F.col("v"), "s", "crc")
    with pytest.raises(ValueError):
        P.hash_value(F.col("v"), "")


def test_anonymize(spark):
    df = spark.createDataFrame([("1", "mail a@b.co", "7", "@x", "X Y", ["@x"])], "id string, text string, author_id string, author_username string, author_name string, mentions array<string>")
    out = P.anonymize_items(df, "s")
    assert not {"author_id", "author_username", "author_name", "mentions"} & set(out.columns)
    row = out.first()
    assert row["author_username_hash"].startswith("user_") and row["mentions_hashes"] == [row["author_username_hash"]] and row["text"] == "mail [REDACTED]_EMAIL"


def test_pseudonyms(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 0)], "u string, o int")
    assert {r["u"]: r["pseudonym"] for r in P.pseudonyms(df, "u", "o").collect()} == {"b": "Person_0001", "a": "Person_0002"}


def test_tokens(spark):
    df = spark.createDataFrame([("We will not vote, the bill is bad!",), ("",), (None,)], "text string").withColumn("t", T.tokenized(F.col("text")))
    rows = df.select("t", T.ngrams(F.col("t.filtered"), 2).alias("g")).collect()
    assert rows[0]["t"]["filtered"] == ["we", "will", "not", "vote", "bill", "bad"] and rows[0]["g"][0] == "we will" and rows[1]["g"] == []


def test_keywords_in_parts_case_and_additions(spark):
    words = K.add_keywords(K.add_keywords(K.built_in(spark), ["Levy", "river levy", "vote"], "money", "tax", 3.0), ["NATO"], "bodies")
    rows = {r["keyword"]: r for r in words.collect()}
    assert rows["vote"]["category"] == "money" and rows["river levy"]["weight"] == 3.0 and rows["nato"]["category"] == "bodies"
    df = spark.createDataFrame([("The river levy vote in the Senate, says NATO", 1), (None, 2), ("", 3)], "text string, i int")
    plain = [r["matches"] for r in K.match(df, words).orderBy("i").collect()]
    assert plain == [r["matches"] for r in K.match(df, words, most=3).orderBy("i").collect()]
    assert [m["keyword"] for m in plain[0]] == ["river levy", "vote", "Senate", "NATO"] and plain[1] is None and plain[2] == []
    exact = spark.createDataFrame([("NATO", "bodies", None, 1.0), ("senate", "x", None, 1.0)], "keyword string, category string, subcategory string, weight double")
    assert [m["keyword"] for m in K.match(df, exact, case_sensitive=True).orderBy("i").first()["matches"]] == ["NATO"]


def test_keywords_without_the_native_automaton(monkeypatch):
    import sys

    entries = [("levy", "a", None, 1.0), ("river levy", "a", None, 1.0), ("vy v", "b", None, 1.0), ("vote", "b", None, 1.0)]
    text = "the River levy vote and a levy"
    native = K.Automaton(entries).match(text)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert K.Automaton(entries).match(text) == native and len(native) == 3
