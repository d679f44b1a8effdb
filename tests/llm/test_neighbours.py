import numpy as np
import pytest

from shelfmark.llm import neighbours

SF = "/root/testdata/sf0.1"


def exact(vectors, ids, query, k):
    apart = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, apart)) if i != query][:k]
    return [(int(ids[i]), apart[i]) for i in order]


def test_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    vectors, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = neighbours.nearest(table, "vec_id % 100 = 0").collect()
    hits = total = 0
    for query in np.flatnonzero(ids % 100 == 0):
        own = sorted((r for r in got if r["query_id"] == ids[query]), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in own] == sorted((r["score"], r["vec_id"]) for r in own)
        best = dict(exact(vectors, ids, query, 10))
        hits += len(best.keys() & {r["vec_id"] for r in own})
        total += 10
        for r in own:
            assert r["score"] == pytest.approx(best.get(r["vec_id"], r["score"]))
    assert hits / total >= 0.9


def test_pigeonhole_finds_all_codes_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 16, (300, 8), dtype=np.uint16)
    codes[150:] = codes[:150] ^ (rng.random((150, 8)) < 0.3) * rng.integers(0, 1 << 16, (150, 8)).astype(np.uint16)
    index = neighbours.SubstringIndex(codes)
    apart = np.bitwise_count(codes[:40, None] ^ codes[None]).sum(axis=2)
    for radius in (0, 3, 8, 21, 50, 128):
        query, row = index.within(codes[:40], radius)
        assert set(zip(query.tolist(), row.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius))))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(1, 30)]
    odd = [(100, None), (200, []), (300, [0.0, 0.0, 0.0]), (400, [1.0, None, 1.0]), (500, [nan, 1.0, 1.0]),
           (600, [inf, 1.0, 1.0]), (700, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (800, [1.0, 1.0, 1.0]),
           (800, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, "vec_id % 100 = 0", k=5).collect()
    assert {r["query_id"] for r in got} == {800} and len(got) == 10
    first = [r for r in got if r["rank"] == 1]
    assert all(r["score"] == 0.0 for r in first)
    assert neighbours.nearest(table.filter("vec_id = 800"), "vec_id % 100 = 0", k=5).count() == 2
    assert neighbours.nearest(table.limit(0), "vec_id % 100 = 0").count() == 0
    assert neighbours.nearest(table.filter("vec_id = 100"), "vec_id % 100 = 0").count() == 0


def test_large_ids_beside_null_ids(spark):
    rng = np.random.default_rng(4)
    base = (1 << 53) + 1
    rows = [(base + i if i % 5 else None, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 8)))]
    rows += [((1 << 63) - 1, rows[1][1]), (base + 1, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, f"vec_id = {base + 1}", k=41).collect()
    own = [r for r in got if r["query_id"] == base + 1]
    assert len(own) == 2 * 41
    met = [r["vec_id"] for r in own]
    assert met.count(None) == 16 and {i for i in met if i is not None} == {i for i, _ in rows if i is not None}
