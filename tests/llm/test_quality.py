import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    held = quality.scores(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held["doc_id"])
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.98
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positives = rng.normal(1.5, 1, (1500, 4))
    for prior in (0.3, 0.7):
        mixed = np.where(rng.random((4000, 1)) < prior, rng.normal(1.5, 1, (4000, 4)), rng.normal(-1.5, 1, (4000, 4)))
        assert abs(quality.estimate_prior(positives, mixed) - prior) < 0.08


def test_non_negative_risk_separates():
    rng = np.random.default_rng(0)
    positives = rng.normal(1, 1, (800, 5))
    truth = rng.random(3000) < 0.4
    unlabelled = np.where(truth[:, None], rng.normal(1, 1, (3000, 5)), rng.normal(-1, 1, (3000, 5)))
    model = quality.fit(positives, unlabelled, 0.4)
    assert ((model.score(unlabelled) > 0.5) == truth).mean() > 0.95


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(40)] + [(1, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.scores(awkward, labels).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert quality.keep_good(awkward, labels).columns == awkward.columns


def test_features_do_not_depend_on_chunks():
    long = "Some words, and more. " * 60_000
    assert quality.features(long).shape == quality.features("").shape == (quality.WIDTH,)
    assert np.isfinite(quality.features(long)).all()


def test_nothing_to_learn_from(spark, awkward, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.scores(awkward, labels).select("score").distinct().collect()[0][0] == 0.5
    assert quality.keep_good(awkward, labels).count() == awkward.count()
    assert quality.scores(nothing, labels).count() == 0
    assert awkward.select(quality.held_out("doc_id").alias("h")).filter(F.col("h").isNull()).count() == 0
