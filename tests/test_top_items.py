import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import recommend as rec
from shelfmark.operators import top_items as ti
from shelfmark.operators.top_items import blocks_needed, top_items

SCHEMA = "id long, features array<double>"


def frame(spark, vectors, ids=None, parts=4):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(users, items, k, user_ids=None, item_ids=None):
    """Full scoring."""
    user_ids = range(len(users)) if user_ids is None else user_ids
    item_ids = range(len(items)) if item_ids is None else item_ids
    found = set()
    for u, user in zip(user_ids, users):
        scores = sorted((-float(np.float32(user @ item)), int(i)) for i, item in zip(item_ids, items))
        found |= {(int(u), i, -s) for s, i in scores[:k]}
    return found


def rows(result):
    got = [(r["user"], r["item"], r["score"]) for r in result.rows.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("signed", [False, True])
def test_equal_to_full_scoring(spark, signed):
    """Whole numbers, so that scores are exact and ties are many."""
    rng = np.random.default_rng(1)
    low = -4 if signed else 0
    users = rng.integers(low, 5, (150, 6)).astype(float)
    items = rng.integers(low, 5, (900, 6)) * rng.choice([1, 1, 1, 2, 8], 900)[:, None].astype(float)
    items[:40] = 0
    users[:3] = 0
    for head, block, group, parts in ((50, 100, 40, 3), (10, 64, 1000, 7), (2000, 100, 10, 2)):
        found = top_items(frame(spark, users, parts=parts), frame(spark, items, parts=parts), 7, head, block, group)
        assert rows(found) == brute(users, items, 7)


def test_most_pairs_stay_unscored(spark):
    """Lengths that fall off as those of items do: the share scored falls, the rows stay."""
    rng = np.random.default_rng(2)
    users = np.abs(rng.normal(size=(300, 8))).round(2)
    items = (np.abs(rng.normal(size=(3000, 8))) / (1 + np.arange(3000) / 100)[:, None]).round(3)
    found = top_items(frame(spark, users), frame(spark, items), 10, head=200, block_items=200, group_users=100)
    effort = found.effort.first()
    assert (effort["users"], effort["items"], effort["pairs"]) == (300, 3000, 900_000)
    assert 300 * 200 <= effort["scored"] < 0.2 * effort["pairs"]
    got = {(u, i) for u, i, _ in rows(found)}
    assert got == {(u, i) for u, i, _ in brute(users, items, 10)}


def test_vectors_that_point_one_way(spark):
    """Factors of ratings without structure: all are about as long, but few items lie far enough out to reach a floor."""
    rng = np.random.default_rng(3)
    mixed = np.eye(4) + rng.normal(size=(4, 4)) / 4
    users = np.abs(rng.normal(size=(300, 4))).round(2)
    items = np.abs(1 + rng.normal(size=(6000, 4)) @ mixed / 16).round(3)
    found = top_items(frame(spark, users), frame(spark, items), 3, head=200, block_items=200, group_users=100)
    assert found.effort.first()["scored"] < 0.2 * 300 * 6000
    assert {(u, i) for u, i, _ in rows(found)} == {(u, i) for u, i, _ in brute(users, items, 3)}


def test_users_move_once(spark):
    """What is sent grows with users and items, not with users times blocks."""
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(200, 16)).round(2), rng.normal(size=(1500, 16)).round(2)
    found = top_items(frame(spark, users), frame(spark, items), 5, head=20, block_items=10, group_users=50)
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Window" not in plan
    assert {(u, i) for u, i, _ in rows(found)} == {(u, i) for u, i, _ in brute(users, items, 5)}


def test_users_of_one_id_share_a_list(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], SCHEMA)
    items = spark.createDataFrame([(10 + i, [float(i), float(20 - 2 * i)]) for i in range(12)], SCHEMA)
    got = rows(top_items(users, items, 3, head=4, block_items=2, group_users=1))
    assert got == {(1, 10, 20.0), (1, 11, 18.0), (1, 12, 16.0), (2, 10, 20.0), (2, 11, 19.0), (2, 12, 18.0)}


def test_blocks_needed():
    longest = np.array([5.0, 3.0, 1.0, 0.0])
    floor = np.array([-np.inf, 0.0, 6.0, 6.1, 100.0, -2.0, 7.0], np.float32)
    lengths = np.array([2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 0.0])
    assert blocks_needed(lengths, floor, longest).tolist() == [4, 4, 2, 1, 0, 4, 0]


def test_awkward_rows(spark):
    users = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (None, [1.0, 1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None])]
    items = [(9, [2.0, 0.0]), (7, [2.0, 0.0]), (5, [0.0, 0.0]), (3, [-1.0, 0.0]), (None, [9.0, 9.0]),
             (1, [float("inf"), 0.0]), (2, None)]
    users, items = spark.createDataFrame(users, SCHEMA), spark.createDataFrame(items, SCHEMA)
    want = {(1, 7, 2.0), (1, 9, 2.0), (1, 5, 0.0), (2, 3, 0.0), (2, 5, 0.0), (2, 7, 0.0)}
    for head in (1, 2, 10):
        assert rows(top_items(users, items, 3, head, 1, 1)) == want
    assert len(rows(top_items(users, items, 10, 2, 1, 1))) == 8
    none = users.limit(0)
    assert rows(top_items(none, items, 3, 2, 1, 1)) == rows(top_items(users, none, 3)) == set()
    assert top_items(users, none, 3).effort.first()["scored"] == 0


def test_recommendations_are_those_of_full_scoring(spark):
    pairs = spark.range(3000).select((F.col("id") % 50).cast("int").alias("user_idx"),
                                     (F.floor(F.col("id") / 50)).cast("int").alias("book_idx"))
    ratings = pairs.withColumn("rating", (1 + F.pmod(F.xxhash64("user_idx", "book_idx"), F.lit(5))).cast("double"))
    model = rec.fit_als(ratings.filter("(user_idx + book_idx) % 3 > 0"), rank=5, max_iter=3)
    got = rec.recommendations(model, 8)
    assert got.dtypes == [("book_idx", "int"), ("user_idx", "int"), ("score", "float")]
    full = model.recommendForAllUsers(8).select("user_idx", F.inline("recommendations"))
    scores = {}
    for name, source in (("got", got), ("full", full.withColumnRenamed("rating", "score"))):
        for r in source.collect():
            scores.setdefault((name, r["user_idx"]), []).append(r["score"])
    for user in range(50):
        assert sorted(scores["got", user]) == pytest.approx(sorted(scores["full", user]), abs=1e-5)


def test_many_ties_are_scored_some_at_a_time(spark, monkeypatch):
    """Scores are added up in pieces, coordinate by coordinate, whoever else is a candidate; vectors that overflow do no harm."""
    monkeypatch.setattr(ti, "FOUND", 7)
    rng = np.random.default_rng(8)
    users, items = rng.normal(size=(9, 5)), np.repeat(rng.normal(size=(20, 5)), 15, axis=0)
    ids = rng.permutation(len(items)).astype(np.int64)
    best = ti.Best(users, 4, ti.Shape.of(len(items), items.sum(axis=0), items.T @ items))
    for begin in range(0, len(items), 64):
        best.offer(ids[begin:begin + 64], items[begin:begin + 64], np.inf)
    for user, found, scores in zip(users, *best.lists()):
        exact = np.zeros(len(items))
        for c in range(5):
            exact += user[c] * items[:, c]
        order = np.lexsort((ids, -exact.astype(np.float32)))[:4]
        assert found == ids[order].tolist() and scores == exact.astype(np.float32)[order].tolist()


def test_users_without_a_better_item_are_not_searched(monkeypatch):
    """Of a product of users and items only rows whose greatest score reaches the floor are gone through."""
    rng = np.random.default_rng(9)
    users, items = rng.normal(size=(300, 6)), rng.normal(size=(4000, 6))
    best = ti.Best(users, 3, ti.Shape.of(len(items), items.sum(axis=0), items.T @ items))
    seen, whole = [], np.flatnonzero
    for begin in range(0, 4000, 400):
        monkeypatch.setattr(np, "flatnonzero", lambda x: (seen.append((begin, x.shape)), whole(x))[1])
        best.offer(np.arange(begin, begin + 400), items[begin:begin + 400], np.inf)
    monkeypatch.undo()
    gone_through = [shape[0] for begin, shape in seen if len(shape) == 2 and begin >= 2000]
    assert len(gone_through) == 5 and max(gone_through) < 200
    exact = users @ items.T
    assert [sorted(f) for f in best.lists()[0]] == [sorted(np.argsort(-e)[:3].tolist()) for e in exact]
