import random

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from shelfmark.operators import clustering as cl, topic_model as tm

SLOTS = 300


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = [(i, [min(SLOTS - 1, int(rng.paretovariate(0.5)) + 40 * (i % 4)) for _ in range(rng.randint(0, 60))])
            for i in range(150)]
    rows += [(None, [1, 1, 2]), (None, []), (7, rows[7][1]), (9000, [5] * 20_000)]
    return spark.createDataFrame(rows, "id int, words array<int>").repartition(7)


def test_weights_are_the_librarys(spark, texts):
    """One row a text and one a term and task leave a task, and the topics are those of MLlib's graph."""
    weights = tm.term_weights(texts, 4, 5, SLOTS, 3, 42, "id", "words")
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(SLOTS)], inputCol="t", outputCol="features")
    vectors = cl.fixed_partitions(counter.transform(texts.withColumn("t", F.col("words").cast("array<string>"))), "id", 3)
    model = LDA(k=4, maxIter=5, seed=42, optimizer="em").fit(vectors)
    assert np.allclose(weights.T, model.topicsMatrix().toArray(), rtol=1e-9, atol=1e-9)
    assert weights.sum() == pytest.approx(texts.agg(F.sum(F.size("words"))).first()[0])


def test_two_fits_give_the_same_shares(spark):
    rows = [(i, "T", " ".join(random.Random(i).choices("love war magic city river stone".split(), k=9))) for i in range(60)]
    books = spark.createDataFrame(rows, "book_id int, title string, description string")
    one, other = ({r["book_id"]: r["weight"] for r in cl.lda_topics(books.repartition(n), k=3, max_iter=3)[0].collect()}
                  for n in (2, 5))
    assert one == pytest.approx(other, rel=1e-9)


def test_no_texts_and_one_topic(spark, texts):
    assert tm.term_weights(texts.limit(0), 3, 2, SLOTS, 2, 42, "id", "words").tolist() == [[0.0] * SLOTS] * 3
    with pytest.raises(ValueError):
        tm.topic_model(texts, 1, 2, SLOTS, 2, 42, "id", "words")


def test_draws_are_those_of_java(spark, monkeypatch):
    monkeypatch.setattr(tm, "AT_ONCE", 10)
    for seed in (0, 57, -3):
        java, draws = spark._jvm.java.util.Random(seed), tm.JavaDraws(seed, 3)
        got = np.concatenate([draws.rows(n) for n in (1, 25, 10)], axis=1)
        assert got.T.ravel().tolist() == [java.nextDouble() for _ in range(108)]


def test_pieces_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(tm, "AT_ONCE", 10)
    assert list(tm._cut(np.array([0, 4, 10, 11, 40, 40, 45]))) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_predictions_are_the_librarys(spark, texts, monkeypatch):
    """Shares of topics made for many texts at once, against those that MLlib's model makes one by one."""
    monkeypatch.setattr(tm, "AT_ONCE", 500)
    model = tm.topic_model(texts, 4, 5, SLOTS, 3, 42, "id", "words")
    more = texts.unionByName(spark.createDataFrame([(9001, None)], "id int, words array<int>"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(SLOTS)], inputCol="t", outputCol="features")
    vectors = counter.transform(more.withColumn("t", F.coalesce(F.col("words").cast("array<string>"), F.array())))
    want = sorted((str(r["id"]), r["topic_weights"].toArray().tolist()) for r in model.transform(vectors).collect())
    monkeypatch.setattr(tm, "TOGETHER", 300)
    got = sorted((str(r["id"]), r["w"]) for r in tm.predicted(more, model, "words", "w").collect())
    assert [i for i, _ in got] == [i for i, _ in want] and len(got) == 155
    assert np.allclose([w for _, w in got], [w for _, w in want], rtol=1e-7, atol=1e-12)


def test_digamma_is_a_derivative():
    x = np.array([1e-3, 0.3, 1.0, 4.5, 60.0])
    want = [-1000.5755719318103, -3.5025242222001332, -0.5772156649015329, 1.388870926359534, 4.085988081383544]
    assert np.allclose(tm.digamma(x), want, rtol=1e-12)
    assert tm.digamma(np.zeros(2)).tolist() == [-np.inf] * 2


def test_lists_as_bytes_come_back():
    values, ends = np.arange(7, dtype=np.int32), np.array([0, 3, 3, 7])
    back, at = tm._numbers(tm._bytes(values, ends).slice(1), np.int32)
    assert back.tolist() == [3, 4, 5, 6] and at.tolist() == [0, 0, 4]
