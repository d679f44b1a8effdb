import hashlib
import math
import random

import numpy as np

from shelfmark.llm import centroids

NAN, INF = float("nan"), float("inf")


def by_hand(rows, k=16, rounds=3):
    """The whole clustering in Python's whole numbers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middles))

    for _ in range(rounds):
        owners = [nearest(v)[1] for _, v in kept]
        for n in range(len(middles)):
            own = [v for (_, v), o in zip(kept, owners) if o == n]
            if own:
                middles[n] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, o, d in found if o == n) for n in range(len(middles))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digests[n]) for i, n, d in found), key=repr)


def result(table, **how):
    return sorted((tuple(r) for r in centroids.cluster_vectors(table, **how).collect()), key=repr)


def test_against_whole_numbers(spark):
    rng = np.random.default_rng(2)
    # Clumps, of which one holds a third of all vectors in copies.
    vectors = np.repeat(rng.normal(size=(12, 64)), 20, axis=0) + rng.normal(size=(240, 64)) * 0.3
    vectors[:80] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    for partitions in (1, 7):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(partitions)
        assert result(table) == by_hand(rows)


def test_awkward_vectors(spark):
    rng = random.Random(3)
    good = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(good)] + [(3, good[3]), (3, good[4]), (None, good[5]), (None, good[5])]
    rows += [(100, None), (101, []), (102, good[0][:63]), (103, good[0] + [1.0]), (104, [None] + good[0][1:]),
             (105, [NAN] + good[0][1:]), (106, [INF] + good[0][1:]), (107, [0.0] * 64), (108, [-0.0] * 64)]
    table = spark.createDataFrame([(i, v, "x", 1, [1.0]) for i, v in rows],
                                  "vec_id long, embedding array<double>, q string, cluster int, led array<double>")
    assert result(table) == by_hand(rows)
    assert len(result(table)) == 36


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert result(spark.createDataFrame([], schema)) == []
    for rows in ([(1, [0.5] * 64)], [(1, [0.5] * 64)] * 3, [(1, [0.5] * 64), (2, [-0.5] * 64)]):
        assert result(spark.createDataFrame(rows, schema)) == by_hand(rows)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(40)]
    rows += [(50, [3e8] + [0.0] * 63), (51, [3e8 + 1] + [0.0] * 63), (52, [-4e7] * 64)]
    assert result(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == by_hand(rows)
    # Distances beyond 64 bits are NULL, and so are the sums over them.
    rows += [(60, [1e12] * 64), (61, [1e300] * 64)]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2, rounds=0)
    assert len(got) == 44
    assert all(r[4] is None for r in got) and any(r[2] is None for r in got) and any(r[2] is not None for r in got)


def test_bounds_hold_and_rule_out(spark):
    rng = np.random.default_rng(1)
    q = np.floor(64 * rng.normal(size=(500, 64)) * np.linspace(3, 0.2, 64)).astype(np.int64)
    table = spark.createDataFrame([(v.tolist(),) for v in q], "q array<long>")
    rotation = centroids._rotation(table, 64, 0.95)
    assert rotation.axes.shape[1] < 50
    middles = q[:16]
    full = ((q[:, None] - middles) ** 2).sum(axis=2)
    for number in (1, 5, rotation.axes.shape[1]):
        some = centroids.Rotation(rotation.mean, rotation.axes[:, :number])
        led = some.leading(q)
        assert (centroids.bounds(*led, middles, some) <= full).all()
        cluster, distance, measured = centroids.nearest(q, *led, middles, some)
        assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert measured < 0.4 * full.size


def test_hot_cluster_sums_are_combined_by_task(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(table, k=3, rounds=2)[:50] == by_hand(rows, 3, 2)[:50]
