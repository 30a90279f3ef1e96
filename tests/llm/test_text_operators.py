"""The text operators on small fixtures with awkward rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorasift.llm import leaks, packing, personal_info, sentences, visible_text

TOK = "/opt/tokenizers/byte_bpe_50k.tiktoken"


# ---------------------------------------------------------------- visible text


def table_of(*texts):
    return visible_text.lookalike_table(dict(visible_text._count_batch(texts)))


@pytest.mark.parametrize(
    "a, b",
    [("Ａlby ｔｈｅ", "Alby the"), ("zоning mаp", "zoning map"), ("café", "café"), ("a​b­d", "abd"), ("x y　z", "x y z"), ("oﬃce", "office"), ("ϲouncil", "council"), ("fé​te", "féte"), ("е́té", "été")],
)
def test_looks_the_same(a, b):
    r = visible_text.Rewriter(table_of(a, b, "plain latin text of some length " * 20))
    assert r(a) == r(b) and r(r(a)) == r(a)


@pytest.mark.parametrize("a, b", [("Office", "office"), ("cafe", "café"), ("colour", "color"), ("Straße", "Strasse"), ("a.b", "a,b"), ("x²", "x2"), ("👨‍👩", "👨👩"), ("“q”", '"q"')])
def test_looks_different(a, b):
    r = visible_text.Rewriter(table_of(a, b, "plain latin text " * 20))
    assert r(a) != r(b)


def test_representative_is_the_frequent_one():
    assert visible_text.Rewriter(table_of("сссссс c"))("c") == "с"


def test_visible_found(spark):
    rows = [("1", "hello world", ["TagA"]), ("2", "hеllo world", ["TagB"]), ("3", "hello world", ["ＴａｇＡ"]), ("4", "Hello world", None), ("5", None, []), (None, "hello world", ["TagA"]), ("1", "hello world", ["TagA"]), ("6", "", [None]), ("7", "​", ["taga"])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "tweet_id string, text_raw string, hashtags array<string>, norm string")
    got = {tuple(r) for r in visible_text.found(df).collect()}
    assert got == {("text_raw", "1", "2"), ("text_raw", "1", "3"), ("text_raw", "2", "3"), ("text_raw", "6", "7"), ("hashtags", "1", "3")}
    assert visible_text.found(df.limit(0)).count() == 0
    tags = {r["tag"]: (r["spellings"], r["uses"]) for r in visible_text.consistent_tags(df).collect()}
    assert tags["TagA"] == (2, 4)


def test_hot_text_pairs_only_across_forms(spark):
    rows = [(f"p{i:03}", "same plain text") for i in range(300)] + [("v", "sаme plain text")]
    df = spark.createDataFrame(rows, "m string, t string")
    table = table_of("same plain text " * 50, "sаme")
    assert visible_text.lookalike_pairs(df, "m", "t", table).count() == 300


# ---------------------------------------------------------------- personal information


TEXTS = {
    "1": "Ask Ivo Dovecastle. My aunt Hana Kolbnurcroft waited two hours, write to hana.kolb@mail.example today",
    "2": "call me on +1-555-555-0133 or (521) 555-0134; docket 1234-5678-9012 is still open",
    "3": "My SSN 943-39-4810 leaked and they live at 1738 N. Juniper Terrace apt. 21 again",
    "4": "rosa1990 at example dot com, boxes left at Saddlerweg 17a overnight, Calle Umber 13",
    "5": "Invoice no. 71693596 for chairs, folder 9647/6970, bill 660.502, section 26.10.1", "6": "", "7": None, "8": "so sorry for Devvuhope, Harold and the kids", "9": "Yarrow street was closed again",
}


def pii_tables(spark):
    filler = [(f"f{i}", f"A spokesperson for Ivo Dovecastle counted {i} votes on May {i % 28 + 1}; my aunt Mina Vandmark waited two hours; my SSN 943-39-{4000 + i} leaked; call me on 555-555-{1000 + i}; van parked by {i + 1} Alder Road again; ping a{i}@town.test; docket 1234-5678-{1000 + i}") for i in range(150)]
    tweets = spark.createDataFrame([*TEXTS.items(), ("1", TEXTS["1"]), (None, "x@y.example"), *filler], "tweet_id string, text_raw string")
    given = ["Ivo", "Hana", "Harold", "Mina", "Rosa"]
    contributions = spark.createDataFrame([(f"Kolbnurcroft, {g}",) for g in given for _ in range(3)], "contributor_name string")
    return tweets, contributions, spark.createDataFrame([("Ivo Dovecastle",), (None,)], "name string")


def test_personal_info(spark):
    tweets, contributions, candidates = pii_tables(spark)
    spans = personal_info.found_spans(tweets, contributions, candidates)
    got = {(r["tweet_id"], r["pii_type"], r["pii_text"]) for r in spans.collect() if not r["tweet_id"].startswith("f")}
    assert got == {
        ("1", "NAME", "Hana Kolbnurcroft"), ("1", "EMAIL", "hana.kolb@mail.example"), ("2", "PHONE", "+1-555-555-0133"), ("2", "PHONE", "(521) 555-0134"), ("3", "ID_NUMBER", "943-39-4810"),
        ("3", "ADDRESS", "1738 N. Juniper Terrace apt. 21"), ("4", "EMAIL", "rosa1990 at example dot com"), ("4", "ADDRESS", "Saddlerweg 17a"), ("4", "ADDRESS", "Calle Umber 13"), ("8", "NAME", "Devvuhope, Harold"),
    }
    clean = {r["tweet_id"]: r["text"] for r in personal_info.redact(tweets, spans).collect()}
    assert clean["3"] == "My SSN [ID_NUMBER] leaked and they live at [ADDRESS] again" and clean["5"] == TEXTS["5"] and clean["7"] is None and clean["6"] == ""
    assert personal_info.found_spans(tweets.limit(0), contributions, candidates).count() == 0


def test_patterns_learn_reliability():
    none, email = 0, 1
    patterns = [("EMAIL", (email, -1, -1, -1, -1, email, -1), 50), ("EMAIL", (none, -1, -1, -1, -1, none, -1), 50), ("EMAIL", (email, none, -1, -1, -1, email, -1), 25), ("EMAIL", (none, email, -1, -1, -1, none, -1), 25)]
    p = personal_info.label_patterns(patterns)
    assert p[patterns[2][:2]].argmax() == email and p[patterns[3][:2]].argmax() == none


# ---------------------------------------------------------------- packing


def test_best_fit_keeps_every_constraint():
    rnd = np.random.default_rng(1)
    size = rnd.integers(1, 500, 3000)
    for rule in ("norm", "dot"):
        bins = packing.best_fit(size, 512, 32, 0.8 * 512 * 512, rule=rule)
        for b in np.unique(bins):
            own = size[bins == b]
            assert own.sum() <= 512 and len(own) <= 32 and ((own.astype(float) ** 2).sum() <= 0.8 * 512 * 512 or len(own) == 1)
    bins = packing.best_fit(size, 512, 64, 512.0 * 512)
    assert size.sum() / (512 * (bins.max() + 1)) > 0.97
    assert len(packing.best_fit(np.array([], int), 512, 8, 1.0)) == 0


def test_pack(spark):
    rows = [(1, "word " * 900), (2, "short text"), (3, ""), (4, None), (5, "a b c"), (5, "a b c"), (None, "lost"), *[(10 + i, "some words here " * (i % 40)) for i in range(200)]]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, tokens int")
    kinds = spark.createDataFrame([(1, "s", 128), (2, "m", 1024), (3, "bad", 0)], "window_id long, name string, capacity_tokens long")
    got = packing.pack(docs, kinds, path=TOK).collect()
    assert {r["window_id"] for r in got} == {1, 2}
    fill, pieces = {}, {}
    for r in got:
        if r["bin"]:
            fill[r["window_id"], r["bin"]] = fill.get((r["window_id"], r["bin"]), 0) + r["tok_end"] - r["tok_start"]
            pieces.setdefault((r["window_id"], r["doc_id"]), []).append((r["tok_start"], r["tok_end"]))
    cap = {1: 128, 2: 1024}
    assert all(n <= cap[w] for (w, _), n in fill.items())
    for (w, d), p in pieces.items():
        p.sort()
        assert p[0][0] == 0 and all(a[1] == b[0] for a, b in zip(p, p[1:])) and (len(p) == 1 or p[-1][1] > cap[w])
    assert {r["doc_id"] for r in got if r["bin"] is None} >= {3, 4} and len({r["doc_id"] for r in got}) == 205
    assert packing.pack(docs.limit(0), kinds, path=TOK).count() == 0 and packing.pack(docs, kinds.limit(0), path=TOK).count() == 0


def test_attention_and_documents_bind(spark):
    docs = spark.createDataFrame([(i, "words of a text " * (5 + i % 60)) for i in range(300)], "doc_id long, text string")
    kinds = spark.createDataFrame([(1, "m", 1024)], "window_id long, name string, capacity_tokens long")
    loose = packing.pack(docs, kinds, path=TOK).collect()
    full = packing.pack(docs, kinds, path=TOK, attention_share=0.1, tokens_per_doc=128, rule="dot").collect()
    by = {}
    for r in full:
        by.setdefault(r["bin"], []).append(r["tok_end"] - r["tok_start"])
    for sizes in by.values():
        assert sum(sizes) <= 1024 and len(sizes) <= 8 and (sum(x * x for x in sizes) <= 0.1 * 1024**2 + 1e-6 or len(sizes) == 1)
    assert any(len(sizes) == 8 for sizes in by.values()) and any(sum(x * x for x in sizes) > 0.09 * 1024**2 for sizes in by.values())
    assert len(by) > len({r["bin"] for r in loose})


# ---------------------------------------------------------------- leaks


PASSAGE = "The mayor of Ashwell found 379 errors in the audit report. Ward 44 of Corton asked Ivo Marlow to explain the election audit. A tidy panel in Denby walked out over the honest barrier."


@pytest.mark.parametrize(
    "text, share",
    [
        (PASSAGE, 1.0), ("intro here. " + PASSAGE.lower() + " and more", 1.0), (PASSAGE.replace("errors", "erorrs").replace("barrier", "barrierr"), 1.0),
        (PASSAGE.replace(". Ward", ". An unrelated sentence stands between them here. Ward"), 1.0), (PASSAGE[: PASSAGE.index("A tidy")], 0.6),
        (PASSAGE.replace("379", "412").replace("44", "81").replace("Denby", "Selby").replace("Ashwell", "Marby"), 0.0), ("The mayor of Ashwell found nothing.", 0.0), ("", 0.0),
    ],
)
def test_covered(text, share):
    words = leaks.tokens(text)
    got = leaks.covered(leaks.passage_sentences(PASSAGE), words, leaks.pair_positions(words))
    assert got >= 0.5 if share >= 0.5 else got < 0.5


def test_leaks(spark):
    zh = "洪水过后，南桥镇有一半票箱是空的。清点在7盏灯笼下进行，几乎到天亮。"
    docs = [(1, PASSAGE), (2, "some other text about the mayor and the audit"), (3, "x " * 5000 + PASSAGE), (4, "前文。" + zh), (5, None), (6, ""), (1, PASSAGE), (None, PASSAGE)]
    items = [(1, PASSAGE), (2, PASSAGE), (3, zh), (4, None), (5, ""), (6, "!!!"), (None, PASSAGE), (7, "A passage that stands nowhere at all, not even partly, in any of the documents")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, k int")
    i = spark.createDataFrame([(*r, "y") for r in items], "item_id long, passage string, d string")
    assert {(r["item_id"], r["doc_id"]) for r in leaks.leaks(d, i).collect()} == {(1, 1), (2, 1), (1, 3), (2, 3), (3, 4)}
    assert {(r["item_id"], r["doc_id"]) for r in leaks.verbatim(d, i).collect()} == {(1, 1), (2, 1), (1, 3), (2, 3), (3, 4)}
    # one stored index serves further test sets, and a large test set in parts
    index = leaks.build_index(d).persist()
    assert {(r["item_id"], r["doc_id"]) for r in leaks.search(index, i.where("item_id = 3")).collect()} == {(3, 4)}
    assert {(r["item_id"], r["doc_id"]) for r in leaks.search(index, i, most=2).collect()} == {(1, 1), (2, 1), (1, 3), (2, 3), (3, 4)}
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0


def test_leaks_like_brute_force(spark):
    """Stretches of half a passage, cut in the middle of sentences, and slips in them."""
    rnd = random.Random(3)
    common, rare = [f"com{chr(97 + i)}" for i in range(20)], [f"{a}{b}rare{c}" for a in "bdfg" for b in "aeiou" for c in "klmnprst"]
    sentence = lambda: [*rnd.sample(common, 9), *rnd.sample(rare, 5)]  # noqa: E731  the rare words stand at the end
    items = [(k, " ".join(" ".join(["The", *sentence()]) + "." for _ in range(4))) for k in range(30)]
    docs = []
    for k, p in items:
        words = p.split()
        for part in (0.5, 0.55, 0.8):
            n = -int(-part * len(words) // 1)
            at = rnd.randrange(len(words) - n + 1)
            cut = [w if rnd.random() < 0.93 else w[:2] + w[3:] for w in words[at : at + n]]
            docs.append((len(docs), " ".join(["Before this", *rnd.sample(common, 5), *cut, *rnd.sample(common, 5)])))
        # of every sentence the words before its rare ones
        docs.append((len(docs), " ".join(" ".join(words[15 * i : 15 * i + 9]) + "." for i in range(4))))
    want = set()
    for d, t in docs:
        w = leaks.tokens(t)
        want |= {(k, d) for k, p in items if leaks.covered(leaks.passage_sentences(p), w, leaks.pair_positions(w)) >= 0.5}
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string"))
    assert {(r["item_id"], r["doc_id"]) for r in got.collect()} == want and len(want) >= 60


# ---------------------------------------------------------------- sentences


def units(text):
    return [text[a:b] for a, b in sentences.sentence_spans(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Why? Dr. Ann Lee met J. R. Oak at 7 p.m. The vote ended. Fig. 3a shows 4.5 percent!", ["Why?", "Dr. Ann Lee met J. R. Oak at 7 p.m.", "The vote ended.", "Fig. 3a shows 4.5 percent!"]),
        ('He wrote: "It is late." Half left. “Is it so?” asked the clerk.', ['He wrote: "It is late."', "Half left.", "“Is it so?” asked the clerk."]),
        ('"We lost! It is over," said Ann. Next.', ['"We lost! It is over," said Ann.', "Next."]),
        ("The gates open at 7 a.m. Sunday. It was built by Hale & Sons Ltd. The fee rose.", ["The gates open at 7 a.m. Sunday.", "It was built by Hale & Sons Ltd.", "The fee rose."]),
        ("It ended.The next began. Nobody expected it ... and yet it came.", ["It ended.", "The next began.", "Nobody expected it ... and yet it came."]),
        ("Notes on the fee\n\nIt was one line\nof running text. Done.", ["Notes on the fee", "It was one line\nof running text.", "Done."]),
        ("1. first thing. still first\n2. second\n* third", ["1. first thing. still first", "2. second", "* third"]),
        ("Am 8. Januar sprach Dr. Oak ca. 5 Minuten, z. B. hier. „Das ist nicht fair!“, rief er.", ["Am 8. Januar sprach Dr. Oak ca. 5 Minuten, z. B. hier.", "„Das ist nicht fair!“, rief er."]),
        ("« C'est injuste ! » a crié Oak. D'après l'art. 5, c'est voté. Qui va payer ? Nous.", ["« C'est injuste ! » a crié Oak.", "D'après l'art. 5, c'est voté.", "Qui va payer ?", "Nous."]),
        ("Комиссия в г. Боринск проверит др. документы. «Это нечестно!» — крикнул он.", ["Комиссия в г. Боринск проверит др. документы.", "«Это нечестно!» — крикнул он."]),
        ("“这不公平！”他喊道。他说：“再查。”他们等了……结果通过了。", ["“这不公平！”他喊道。", "他说：“再查。”", "他们等了……结果通过了。"]),
        ("「公平ではない！」と彼は叫んだ。残る…と言う。", ["「公平ではない！」と彼は叫んだ。", "残る…と言う。"]),
        ("डॉ. आरव ने बात की। मतदान बढ़ा।", ["डॉ. आरव ने बात की।", "मतदान बढ़ा।"]),
        ('قال: "هذا غير عادل!" لم يسأل أحد. من سيدفع؟', ['قال: "هذا غير عادل!"', "لم يسأل أحد.", "من سيدفع؟"]),
        ("ใครจะจ่าย ไม่มีใครถาม", ["ใครจะจ่าย", "ไม่มีใครถาม"]),
        ("all is lower here. the next one too. it cost 5 p.m. sharp", ["all is lower here.", "the next one too.", "it cost 5 p.m. sharp"]),
        ("", []), (None, []), (" \n \n", []), ("no end", ["no end"]),
    ],
)
def test_sentences(text, want):
    assert (units(text) if text else [x for x in sentences.sentence_spans(text)]) == want


def test_sentence_rows(spark):
    long = "One sentence here. " * 20_000
    df = spark.createDataFrame([(1, "All went. Two left."), (1, "All went. Two left."), (2, None), (3, ""), (4, long)], "doc_id long, text string")
    got = sentences.sentences(df)
    assert got.where("doc_id = 1").count() == 2 and got.where("doc_id = 4").count() == 20_000 and got.where("doc_id in (2, 3)").count() == 0
    bad = got.join(df.distinct(), "doc_id").where(F.expr("substring(text, int(sent_start) + 1, int(sent_end - sent_start)) rlike '^\\\\s|\\\\s$'"))
    assert bad.count() == 0


def test_queries_are_registered():
    from agorasift.llm import queries

    assert {"p1_found", "p3_found", "p8_windows", "p9_found", "p10_found"} <= set(queries.QUERIES)
    assert dt.date.today() and set(queries.ORACLES) <= set(queries.QUERIES)
