"""K-means centres that are the same however the rows are dealt over tasks.

Vectors are put on a grid of whole numbers that is fine enough to tell them apart and
coarse enough for every distance to be exact in a double. Sums over tasks are whole
numbers, and random draws are hashes of the rows, so nothing depends on the number of
partitions, their order, or a task that is run again. Predictions are MLlib's.
"""

from collections.abc import Iterator
from math import frexp
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from ..checkpoints import materialise

#: Rounds of the seeding, each of which draws some OVERSAMPLING * k rows; more only while there are too few seeds.
SEED_ROUNDS, MOST_SEED_ROUNDS, OVERSAMPLING = 3, 20, 2
MAX_ROUNDS, TOLERANCE = 20, 1e-4


#: Components that are spread out at once.
SPREAD = 1 << 20


def _points(batch: pa.RecordBatch, dimensions: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The points of a batch with their draws, some rows at a time; only components that are not zero are stored."""
    ends = batch.column("at").offsets.to_numpy()
    at = batch.column("at").values.to_numpy(zero_copy_only=False)
    values = np.rint(batch.column("x").values.to_numpy(zero_copy_only=False) * scale)
    draws = batch.column("draw").to_numpy(zero_copy_only=False)
    shift = ends - batch.column("x").offsets.to_numpy()
    step = max(1, SPREAD // max(dimensions, 1))
    for begin in range(0, batch.num_rows, step):
        end = min(begin + step, batch.num_rows)
        low, high = ends[begin], ends[end]
        q = np.zeros((end - begin, dimensions))
        q[np.repeat(np.arange(end - begin), np.diff(ends[begin:end + 1])), at[low:high]] = values[low - shift[0]:high - shift[0]]
        yield q, draws[begin:end]


def _apart(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to every centre: whole numbers below 2 ** 53, so exact in any order of adding up."""
    return (q * q).sum(axis=1)[:, None] - 2 * (q @ centres.T) + (centres * centres).sum(axis=1)


def _whole_sum(values: np.ndarray) -> int:
    """The exact sum of whole doubles."""
    whole = values.astype(np.int64)
    return (int((whole >> 26).sum()) << 26) + int((whole & ((1 << 26) - 1)).sum())


class _Grid:
    """The vectors of a fit, with what is asked of all of them at once."""

    def __init__(self, vectors: DataFrame, features: str, seed: int):
        # The other columns tell copies of a vector apart, each of which has a draw of its own.
        others = [c for c in vectors.columns if c != features]
        points = vectors.select(vector_to_array(features).alias("_all"), *others)
        full = F.filter(F.arrays_zip(F.sequence(F.lit(0), F.size("_all") - 1).alias("at"), F.col("_all").alias("x")),
                        lambda c: c["x"] != 0)
        # Stored once as what is not zero, as texts have few of the words there are; each round reads it all.
        self.rows = materialise(points.select(
            full.alias("full"), F.size("_all").alias("size"), F.xxhash64(F.lit(seed), "_all").alias("place"),
            F.xxhash64(F.lit(seed), "_all", *others).alias("draw")).select(
            F.col("full.at").alias("at"), F.col("full.x").alias("x"), "size", "place", "draw"))
        most = F.array_max(F.transform("x", lambda v: F.abs(v)))
        found = self.rows.agg(F.max("size").alias("dimensions"), F.max(F.coalesce(most, F.lit(0.0))).alias("most")).first()
        self.dimensions = found["dimensions"] or 0
        # 4 * dimensions * size ** 2 stays below 2 ** 52.
        bits = (50 - max(self.dimensions, 1).bit_length()) // 2
        self.scale = 2.0 ** (bits - frexp(found["most"] or 1.0)[1])

    def first(self) -> np.ndarray | None:
        """The point that comes first by the hash of its components."""
        row = self.rows.orderBy("place", "at", "x").select("at", "x").first()
        if row is None:
            return None
        point = np.zeros((1, self.dimensions))
        point[0, row["at"]] = row["x"]
        return np.rint(point * self.scale)

    def over_tasks(self, work, schema: str) -> DataFrame:
        """``work`` of the points of each task and their draws."""
        dimensions, scale = self.dimensions, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from work(part for b in batches if b.num_rows for part in _points(b, dimensions, scale))

        return self.rows.select("at", "x", "draw").mapInArrow(run, schema)

    def cost(self, centres: np.ndarray) -> int:
        def work(parts):
            total = sum(_whole_sum(_apart(q, centres).min(axis=1)) for q, _ in parts)
            yield pa.RecordBatch.from_pydict({"cost": pa.array([total], type=pa.decimal128(38, 0))})

        return int(self.over_tasks(work, "cost decimal(38,0)").agg(F.sum("cost")).first()[0] or 0)

    def drawn(self, centres: np.ndarray, cost: int, wanted: int, turn: int) -> np.ndarray:
        """Distinct points, each of their rows drawn with a chance in proportion to its squared distance."""
        def work(parts):
            for q, draws in parts:
                mixed = (draws.view(np.uint64) ^ np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
                chance = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)
                near = _apart(q, centres).min(axis=1)
                picked = q[chance * 2.0 ** -53 * cost < wanted * near]
                yield pa.RecordBatch.from_pydict({"q": pa.array(picked.tolist(), type=pa.list_(pa.float64()))})

        found = self.over_tasks(work, "q array<double>").distinct().collect()
        return np.array([r["q"] for r in found]).reshape(-1, self.dimensions)

    def members(self, centres: np.ndarray, sums: bool = True) -> tuple[list[int], dict[int, list[int]]]:
        """Points nearest to each centre, and the sums of their components."""
        k, dimensions = centres.shape

        def work(parts):
            counts, totals = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
            for q, _ in parts:
                nearest = _apart(q, centres).argmin(axis=1)
                counts += np.bincount(nearest, minlength=k)
                if sums:        # of whole numbers, a batch's sum of which is exact in a double
                    totals += ((nearest == np.arange(k)[:, None]).astype(np.float64) @ q).astype(np.int64)
            met = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "c": met.astype(np.int32), "n": counts[met],
                "sums": pa.array(totals[met].tolist() if sums else [[]] * len(met), type=pa.list_(pa.int64()))})

        parts = self.over_tasks(work, "c int, n long, sums array<long>")
        places = parts.select("c", "n", F.posexplode_outer("sums"))
        found = places.groupBy("c", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"))
        counts, totals = [0] * k, {}
        for row in found.collect():     # no more rows than the centres have components
            counts[row["c"]] = row["n"]
            totals.setdefault(row["c"], [0] * dimensions)
            if row["pos"] is not None:
                totals[row["c"]][row["pos"]] = int(row["sum"])
        return counts, totals


def _weighted(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of some weighted candidates, each drawn in proportion to weight and distance, then moved to their means."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < k:
        near = _apart(candidates, candidates[chosen]).min(axis=1) * weights
        chosen.append(int(rng.choice(len(candidates), p=near / near.sum())))
    centres = candidates[chosen]
    for _ in range(30):
        nearest = _apart(candidates, centres).argmin(axis=1)
        moved = np.stack([np.rint(np.average(candidates[nearest == c], axis=0, weights=weights[nearest == c]))
                          if weights[nearest == c].sum() else centres[c] for c in range(k)])
        if (moved == centres).all():
            break
        centres = moved
    return centres


def centres_of(vectors: DataFrame, k: int, seed: int = 42, features: str = "features", rounds: int = MAX_ROUNDS,
               tolerance: float = TOLERANCE) -> np.ndarray:
    """Up to ``k`` centres of the vectors of a stored frame, which is read once or twice a round.

    Seeds are drawn in rounds of several at a time by hashes of the rows, weighted by
    the points nearest to them, and thinned out to ``k`` on the driver, which sees no more
    than some dozens of rows a round however many there are. Centres then move to the mean
    of their points until none moves further than ``tolerance``. Fewer distinct vectors
    than ``k`` are their own centres; without vectors there are none.
    """
    grid = _Grid(vectors, features, seed)
    candidates, turn = grid.first(), 0
    if candidates is None:
        return np.zeros((0, grid.dimensions))
    # The cost is zero once every distinct vector is a candidate.
    while (turn < SEED_ROUNDS or len(candidates) < k and turn < MOST_SEED_ROUNDS) and (cost := grid.cost(candidates)):
        drawn = grid.drawn(candidates, cost, OVERSAMPLING * k, turn)
        candidates, turn = np.unique(np.concatenate([candidates, drawn]), axis=0), turn + 1
    if len(candidates) <= k:
        centres = candidates
    else:
        centres = _weighted(candidates, np.array(grid.members(candidates, sums=False)[0], dtype=np.float64), k, seed)
    for _ in range(rounds):
        counts, totals = grid.members(centres)
        moved = centres.copy()
        for c, sums in totals.items():
            moved[c] = [(2 * s + counts[c]) // (2 * counts[c]) for s in sums]
        far = ((moved - centres) ** 2).sum(axis=1).max()
        centres = moved
        if far <= (tolerance * grid.scale) ** 2:
            break
    return centres / grid.scale


def kmeans_model(vectors: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    """MLlib's model of the centres of ``features``, predicting ``cluster``."""
    context = vectors.sparkSession.sparkContext
    centres = _py2java(context, [Vectors.dense(c) for c in centres_of(vectors, k, seed)])
    spark = context._jvm.org.apache.spark
    model = KMeansModel(spark.ml.clustering.KMeansModel(f"kmeans_{uuid4().hex[:12]}",
                                                        spark.mllib.clustering.KMeansModel(centres)))
    return model.setFeaturesCol("features").setPredictionCol("cluster")


def scaler_model(numbers: DataFrame, columns: list[str]) -> StandardScalerModel:
    """MLlib's model of the columns' means and deviations, from sums of decimals, which add up alike in any order."""
    # 12 places of values below 10 ** 10, squared at 6 places: beyond that values come to the nearest such number.
    exact = [F.col(c).cast("decimal(28,12)") for c in columns]
    row = numbers.agg(F.count(F.lit(1)), *[F.sum(c.cast("decimal(28,12)")) for c in exact],
                      *[F.sum((c.cast("decimal(18,6)") * c.cast("decimal(18,6)"))) for c in exact]).first()
    n, sums, squares = row[0], row[1:1 + len(columns)], row[1 + len(columns):]
    means = [float(s / n) if n else 0.0 for s in sums]
    spread = [float(max((q - s * s / n) / (n - 1), 0)) ** 0.5 if n > 1 else 0.0 for s, q in zip(sums, squares)]
    context = numbers.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.feature.StandardScalerModel(
        f"scaler_{uuid4().hex[:12]}", *[_py2java(context, Vectors.dense(v)).asML() for v in (spread, means)])
    model = StandardScalerModel(made)
    for name, value in (("inputCol", "features_raw"), ("outputCol", "features"), ("withMean", True), ("withStd", True)):
        model._java_obj.set(model._java_obj.getParam(name), value)
        model._set(**{name: value})
    return model
