import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfmark.operators import clustering as cl, kmeans


@pytest.fixture(scope="module")
def books(spark):
    rows = []
    for i in range(60):
        text = ("A self-help love story", "War and history!", "Magic, fantasy & magic")[i % 3]
        rows.append((i, f"T{i}", text if i else "123", None if i % 10 == 0 else float(i % 5), (i % 3) * 1000 + i,
                     (i % 3) * 500, None))
    return spark.createDataFrame(rows, "book_id int, title string, description string, average_rating double, "
                                       "num_pages int, ratings_count int, text_reviews_count int")


def partition(frame):
    groups = {}
    for r in frame.collect():
        groups.setdefault(r["cluster"], set()).add(r["book_id"] % 3)
    return groups


def test_keyword_clusters(books):
    frame, _ = cl.keyword_clusters(books, k=3)
    assert frame.columns == ["book_id", "title", "cluster"]
    assert frame.count() == 59                 # nothing is left of the text without letters
    assert all(len(kinds) == 1 for kinds in partition(frame).values())
    sizes = cl.cluster_sizes(frame).collect()
    assert sum(r["count"] for r in sizes) == 59 and len(sizes) <= 3


def test_a_hyphenated_keyword_needs_cleaning(books):
    only = ["self-help"]
    assert cl.cluster_sizes(cl.keyword_clusters(books, only, k=2)[0]).count() == 1
    assert cl.cluster_sizes(cl.keyword_clusters(books, only, k=2, clean_keywords=True)[0]).count() == 2


def test_feature_clusters(books):
    frame, _ = cl.feature_clusters(books, k=3)
    assert frame.columns == ["book_id", "title", "avg_rating", "num_pages", "ratings_count", "cluster"]
    assert frame.count() == 60 and frame.filter("avg_rating IS NULL").count() == 0
    assert cl.cluster_sizes(frame).count() <= 3


def test_text_clusters_and_features(books):
    frame, _ = cl.text_clusters(books, k=3)
    assert all(len(kinds) == 1 for kinds in partition(frame).values())
    features, _ = cl.tfidf_features(books)
    assert features.first()["features"].size == 1000


def test_topics(books):
    assigned, topics, _ = cl.lda_topics(books, k=3, terms=4, max_iter=5)
    assert assigned.count() == 59 and assigned.filter("topic NOT BETWEEN 0 AND 2").count() == 0
    assert topics.count() == 3
    assert all(len(r["terms"]) == len(r["termWeights"]) and None not in r["terms"] for r in topics.collect())


def test_clusters_do_not_depend_on_partitions(spark):
    rng = random.Random(6)
    rows = [(i, f"T{i}", rng.uniform(0, 5), rng.randint(1, 900), int(rng.paretovariate(0.5)) % 10**7, rng.randint(0, 50))
            for i in range(900)]
    rows += [(1000 + i, "copy", 4.0, 300, 17, 3) for i in range(500)]        # a third and more are copies
    table = spark.createDataFrame(rows, "book_id int, title string, average_rating double, num_pages int, "
                                        "ratings_count int, text_reviews_count int")
    found = []
    for number in (4, 16, 200):
        frame, model = cl.feature_clusters(table.repartition(number), k=6)
        found.append(({r["book_id"]: r["cluster"] for r in frame.collect()},
                      [c.tolist() for c in model.stages[-1].clusterCenters()]))
    assert found[0] == found[1] == found[2]
    assert len(set(found[0][0].values())) > 3


def test_centres_are_means_and_as_good_as_the_librarys(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(5, 7)) * 10
    points = np.concatenate([m + rng.normal(size=(80, 7)) for m in middles])
    table = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["features"]).repartition(6)
    model = kmeans.kmeans_model(table, 5)
    centres = np.array(model.clusterCenters())
    apart = ((points[:, None] - centres) ** 2).sum(axis=2)
    nearest = apart.argmin(axis=1)
    assert np.allclose([points[nearest == c].mean(axis=0) for c in range(5)], centres, atol=1e-3)
    other = KMeans(k=5, seed=1).fit(table)
    assert apart.min(axis=1).sum() <= other.summary.trainingCost * 1.05


def test_few_vectors_and_none(spark):
    one = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 40, ["features"])
    assert [c.tolist() for c in kmeans.kmeans_model(one, 4).clusterCenters()] == [[1.0, 2.0]]
    assert kmeans.centres_of(one.limit(0), 4).shape == (0, 0)


def test_scaling_from_decimals(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-5, 5), float(rng.randint(0, 10**7))) for _ in range(500)]
    model = kmeans.scaler_model(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    assert np.allclose(model.mean.toArray(), np.mean(rows, axis=0), rtol=1e-9)
    assert np.allclose(model.std.toArray(), np.std(rows, axis=0, ddof=1), rtol=1e-6)


def test_points_are_stored_as_what_is_not_zero(spark):
    """Rounds read that, not all components of every text; centres are those of the same vectors written out."""
    rows = [(i, [(i * 37) % 1000, 1000 + (i * i) % 500], [1.0 + i % 3, 2.5 + i % 7]) for i in range(400)]
    sparse = spark.createDataFrame([(i, Vectors.sparse(1500, sorted(zip(at, x)))) for i, at, x in rows], ["id", "features"])
    dense = spark.createDataFrame([(i, Vectors.dense(v.toArray())) for i, v in sparse.collect()], sparse.schema)
    grid = kmeans._Grid(sparse, "features", 42)
    assert grid.dimensions == 1500 and grid.rows.agg(F.sum(F.size("at"))).first()[0] == 800
    assert (kmeans.centres_of(sparse, 4) == kmeans.centres_of(dense, 4)).all()


def test_rows_off_their_centre_are_counted(spark):
    table = spark.createDataFrame([(i, Vectors.dense([float(i % 5) * 10, 1.0])) for i in range(50)], ["id", "features"])
    model = kmeans.kmeans_model(table, 5)
    found = model.transform(table)
    assert cl.off_centre(found, model).first() == (50, 0)
    wrong = found.withColumn("cluster", F.when(F.col("id") < 7, (F.col("cluster") + 1) % 5).otherwise(F.col("cluster")))
    assert cl.off_centre(wrong, model).first() == (50, 7)
    assert cl.off_centre(found.limit(0), model).first() == (0, 0)
