import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorasift.operators import clean as C


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "text string").select(expr(F.col("text"))).first()[0]


def cleaned(spark, text, **kw):
    return C.clean(spark.createDataFrame([(text,)], "text string"), cfg=C.CleanConfig(**kw)).first()["cleaning"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Hello    world   how   are   you", "Hello world how are you"),
        ("RT @user: Original tweet content here", "Original tweet content here"),
        ("Hello &amp; world &lt;test&gt;", "Hello & world <test>"),
        ("Check this #Election2024 #ClimateChange", "Check this Election2024 ClimateChange"),
        ("Check out https://example.com for more", "Check out for more"),
        ("what?!?! no... yes", "what! no. yes"),
        ("full width ＡＢＣ", "full width ABC"),
        ("", ""),
    ],
)
def test_pipeline(spark, text, want):
    assert cleaned(spark, text)["cleaned"] == want


def test_lists_and_counts(spark):
    c = cleaned(spark, "Hello @user how are you @friend https://a.example #Tag 😀 World 🎉🎉", remove_mentions=True)
    assert c["removed_mentions"] == ["@user", "@friend"] and c["removed_urls"] == ["https://a.example"] and c["hashtags"] == ["Tag"] and c["emoji_count"] == 2
    assert c["metadata"]["mentions_found"] == 2
    assert cleaned(spark, None)["cleaned"] is None


def test_options(spark):
    assert cleaned(spark, "ABC def", lowercase=True, max_length=5)["cleaned"] == "abc d"
    assert cleaned(spark, "a 😀 b", remove_emojis=True)["cleaned"] == "a b"


def test_hashtag_words(spark):
    assert one(spark, "#ClimateChange", C.hashtag_words) == "climate change"
    assert one(spark, "#climate_change", C.hashtag_words) == "climate change"
    assert one(spark, "#GOPDebate", C.hashtag_words) == "g o p debate"


def test_extract(spark):
    assert one(spark, "@José says #Año www.x.example", C.extract_mentions) == ["José"]
    assert one(spark, "@José says #Año www.x.example", C.extract_hashtags) == ["Año"]
    assert one(spark, "see https://a.b/c, now", C.extract_urls) == ["https://a.b/c,"]


def test_language(spark):
    assert one(spark, "This is a text that is written in the English language", C.guess_language) == "en"
    assert one(spark, "Der Hund ist nicht in dem Haus und das ist gut", C.guess_language) == "de"
    assert one(spark, "Это предложение написано по-русски", C.guess_language) == "ru"
    assert one(spark, "short", C.guess_language) is None


def test_keep(spark):
    df = spark.createDataFrame([("This is the first of the long texts that we keep",), ("",), (None,), ("tiny",), ("Der Hund ist nicht in dem Haus und das ist gut",)], "text string")
    assert C.keep_clean(df).count() == 1
    assert C.keep_clean(df, language="all").count() == 2


def test_stats_of_nothing(spark):
    df = spark.createDataFrame([], "text string")
    assert C.text_stats(df).first()["items"] == 0 and C.histogram(df, "text").count() == 0


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=5, max_size=20))
def test_like_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(C.unescape_html(F.col("text")), C.normalize_unicode(F.col("text")), C.squeeze_marks(F.col("text"))).collect()
    for t, (a, b, c) in zip(texts, got):
        assert a == html.unescape(t) and b == unicodedata.normalize("NFKC", t) and c == re.sub(r"([!?.]){2,}", r"\1", t)
