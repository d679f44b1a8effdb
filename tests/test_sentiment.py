import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.text import NOT_LETTERS, alnum_only, letters_only, words
from shelfmark.operators import sentiment as sn
from shelfmark.schemas import LEXICON

TEXTS = [(1, "Good, good BAD"), (2, "good,bad"), (3, "nothing here"), (4, None), (5, ""), (6, "bad good\x1cbad"),
         (7, "Ünïcödé good — bad!"), (8, "good\tbad\x0bgood\r\ngood")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, review_text string")


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [("GOOD", 1.0), ("bad", -0.5), ("bad", -1.0), (None, 1.0), ("void", None)]
    return spark.createDataFrame(rows, LEXICON)


def expected(text):
    cleaned = re.sub(r"[^a-zA-Z0-9\s]", "", text) if text else ""
    found = [{"good": 1.0, "bad": -0.75}[w] for w in cleaned.lower().split() if w in ("good", "bad")]
    return sum(found) / len(found) if found else 0.0


def test_cleaning_equals_the_unicode_pattern(texts):
    for row in texts.select("review_text", alnum_only(F.col("review_text")).alias("c")).collect():
        assert row["c"] == (re.sub(r"[^a-zA-Z0-9\s]", "", row["review_text"]) if row["review_text"] else "")


def test_letters_only(spark):
    df = spark.createDataFrame([("Self-Help   1x\n",), ("😀é",), (None,)], "t string")
    assert [r[0] for r in df.select(letters_only(F.col("t"))).collect()] == ["selfhelp x\n", "", None]
    plain = df.select(F.lower(F.regexp_replace("t", r"[^a-zA-Z\s]", "")))
    assert plain.collect() == df.select(letters_only(F.col("t"))).collect()
    assert NOT_LETTERS.startswith("(?s)")


def test_words(spark):
    df = spark.createDataFrame([("  A b\n\nC ",), ("",)], "t string")
    assert [r[0] for r in df.select(words(F.col("t"))).collect()] == [["a", "b", "c"], []]


@pytest.mark.parametrize("strategy", [None, "merge"], ids=["broadcast", "shuffled"])
def test_scores(texts, lexicon, strategy):
    scored = sn.score_reviews(texts, lexicon, strategy=strategy)
    assert scored.columns == ["id", "review_text", "sentiment_score", "sentiment_label"]
    got = {r["id"]: r["sentiment_score"] for r in scored.collect()}
    assert got == pytest.approx({i: expected(t) for i, t in TEXTS})


def test_both_ways_agree_on_copies(spark, lexicon):
    copies = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, F.lit("good bad good"))
                                     .otherwise(F.concat(F.lit("bad "), F.col("id") % 7)).alias("review_text"))
    small = sn.score_reviews(copies, lexicon)
    large = sn.score_reviews(copies, lexicon, strategy="merge")
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def test_order_changes_no_bit(spark):
    """Tenths add up to another double in another order; units do not."""
    words = {"a": 0.1, "b": 0.2, "c": 0.3, "d": -0.2, "e": 0.05}
    lexicon = spark.createDataFrame(list(words.items()), LEXICON)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randint(1, 60)))) for i in range(800)]
    rows += [(900, "a a a"), (901, "d a e"), (902, " ".join("aaaaaaaaa")), (903, "a c d b")]
    texts = spark.createDataFrame(rows, "id int, review_text string").repartition(7)
    small, large = ({r["id"]: (r["sentiment_score"], r["sentiment_label"]) for r in
                     sn.score_reviews(texts, lexicon, strategy=strategy).collect()} for strategy in (None, "merge"))
    assert small == large
    assert small[900] == small[902] == small[903] == (0.1, "POSITIVE")


def test_long_texts_are_read_to_the_end(spark, lexicon):
    long = spark.createDataFrame([("x " * 200_000 + "good",)], "review_text string")
    assert sn.score_reviews(long, lexicon).first()["sentiment_score"] == 1.0


def test_punctuation_can_separate_words(texts, lexicon):
    scored = sn.sentiment_score(texts.filter("id = 2"), "review_text", lexicon, replacement=" ")
    assert scored.first()["sentiment_score"] == pytest.approx(0.125)


def test_label_bounds(spark):
    df = spark.createDataFrame([(-0.1,), (-0.0999,), (0.0,), (0.0999,), (0.1,)], "sentiment_score double")
    assert [r[0] for r in df.select(sn.sentiment_label()).collect()] == \
        ["NEGATIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL", "POSITIVE"]


def test_insights_need_more_than_twenty(spark):
    rows = [("a", "A", i / 10, 3) for i in range(20)] + [("b", "B", 0.5, None if i else 4) for i in range(21)]
    df = spark.createDataFrame(rows, "book_id string, title string, sentiment_score double, rating int")
    got = sn.by_sentiment(sn.group_insights(df)).collect()
    assert [tuple(r) for r in got] == [("b", "B", 0.5, 4.0, 21)]
