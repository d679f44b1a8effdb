"""Centroid clustering of whole-number vectors, most centroids ruled out by rotated coordinates.

Vectors are rotated to their principal components. The leading coordinates and the length
of the rest bound every distance from below: the rests differ by at least as much as their
lengths. Centroids that the bound leaves are measured in whole numbers, so neither the
rotation nor rounding has a say in the result.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..checkpoints import materialise

#: Components of a vector, and what they are multiplied with before they are cut to whole numbers.
DIMENSIONS, SCALE = 64, 64
#: The leading coordinates are as few as hold this share of the variance.
EXPLAINED = 0.95
#: Whole numbers below this in size give distances that fit 64 bits.
NARROW = 1 << 27
#: Components of this size and more are no whole numbers of 64 bits.
WIDEST = float(1 << 62)
LONG = (1 << 63) - 1
#: By how much of the squared lengths a bound may be off by rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Rotation:
    """Origin and leading axes, as columns."""
    mean: np.ndarray
    axes: np.ndarray

    def leading(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, length of the rest, and squared length of each vector from the origin."""
        apart = vectors.astype(np.float64) - self.mean
        led = apart @ self.axes
        whole = (apart * apart).sum(axis=1)
        return led, np.sqrt(np.maximum(whole - (led * led).sum(axis=1), 0)), whole


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of whole-number matrices, of Python's numbers where 64 bits are too few."""
    if max(_widest(a), _widest(b)) >= NARROW:
        a, b = a.astype(object), b.astype(object)
    apart = a - b
    return (apart * apart).sum(axis=1)


def _widest(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min())) if m.size else 0


def bounds(led: np.ndarray, rest: np.ndarray, whole: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Per vector and centroid, what their squared distance is at least."""
    c_led, c_rest, c_whole = rotation.leading(centroids)
    led_apart = (led * led).sum(axis=1)[:, None] + (c_led * c_led).sum(axis=1) - 2 * led @ c_led.T
    return led_apart + (rest[:, None] - c_rest) ** 2 - SLACK * (whole[:, None] + c_whole + 1)


def nearest(q: np.ndarray, led: np.ndarray, rest: np.ndarray, whole: np.ndarray, centroids: np.ndarray,
            rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row of ``q``, its exact squared distance, and how many distances were measured.

    The centroid of the least bound comes first; another one is measured where its bound
    is no greater than the least distance so far. Ties go to the smaller number.
    """
    low = bounds(led, rest, whole, centroids, rotation)
    cluster = low.argmin(axis=1).astype(np.int32)
    tried = cluster.copy()
    best = squared(q, centroids[cluster])
    measured = len(q)
    for c in range(len(centroids)):
        rows = np.flatnonzero((low[:, c] <= best) & (tried != c))
        if not len(rows):
            continue
        measured += len(rows)
        distance = squared(q[rows], centroids[[c]])
        better = (distance < best[rows]) | ((distance == best[rows]) & (c < cluster[rows]))
        if distance.dtype == object:
            best = best.astype(object)
        best[rows[better]], cluster[rows[better]] = distance[better], c
    return cluster, best, measured


def usable(vector: Column, dimensions: int, scale: float) -> Column:
    """A vector of so many components, none NULL, not finite, or too large for a whole number of 64 bits."""
    fits = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * scale < WIDEST))
    return F.coalesce((F.size(vector) == dimensions) & fits, F.lit(False))


def _column(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rotated(batches: Iterator[pa.RecordBatch], rotation: Rotation) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        q = _column(batch, "q", len(rotation.mean))
        led, rest, whole = rotation.leading(q)
        led = pa.ListArray.from_arrays(np.arange(len(q) + 1, dtype=np.int32) * led.shape[1], led.ravel())
        yield pa.RecordBatch.from_arrays([*batch.columns, led, pa.array(rest), pa.array(whole)],
                                         [*batch.schema.names, "led", "rest", "whole"])


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, ...]:
    q = _column(batch, "q", len(rotation.mean))
    led = _column(batch, "led", rotation.axes.shape[1])
    rest, whole = (batch.column(name).to_numpy() for name in ("rest", "whole"))
    return q, *nearest(q, led, rest, whole, centroids, rotation)[:2]


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, rotation: Rotation) -> Iterator[pa.RecordBatch]:
    """Vectors of each cluster in a task, and the sums of their components."""
    counts, totals = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=object)
    for batch in batches:
        q, cluster, _ = _assigned(batch, centroids, rotation)
        counts += np.bincount(cluster, minlength=len(centroids))
        if _widest(q) >= NARROW:
            q = q.astype(object)
        for c in np.unique(cluster):
            totals[c] += q[cluster == c].sum(axis=0)
    met = np.flatnonzero(counts)
    exact = pa.list_(pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(met.astype(np.int32)), pa.array(counts[met]),
         pa.array([[Decimal(int(v)) for v in totals[c]] for c in met], type=exact)], ["cluster", "n", "sums"])


def _labelled(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, rotation: Rotation) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, cluster, distance = _assigned(batch, centroids, rotation)
        if distance.dtype == object:
            distance = [d if d <= LONG else None for d in distance.tolist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance, type=pa.int64())],
                                         ["vec_id", "cluster", "distance"])


def _rotation(rows: DataFrame, dimensions: int, explained: float) -> Rotation:
    """Mean and leading principal components of all rows but those of very large components."""
    some = rows.filter(F.forall("q", lambda v: F.abs(v) < NARROW)).select(
        array_to_vector(F.col("q").cast("array<double>")).alias("v"))
    count, mean = some.agg(F.count(F.lit(1)), Summarizer.mean(F.col("v"))).first()
    if count < 2:
        return Rotation(np.zeros(dimensions), np.eye(dimensions)[:, :1])
    fitted = PCA(k=dimensions, inputCol="v", outputCol="led").fit(some)
    held = np.cumsum(np.nan_to_num(fitted.explainedVariance.toArray()))
    leading = min(int(np.searchsorted(held, explained)) + 1, dimensions)
    return Rotation(mean.toArray(), fitted.pc.toArray()[:, :leading])


def _moved(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; those without vectors stay."""
    parts = stored.mapInArrow(lambda batches: _sums(batches, centroids, rotation),
                              "cluster int, n long, sums array<decimal(38,0)>")
    # One row a cluster: sums meet combined by task, then by Spark.
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("sums")[i]) for i in range(centroids.shape[1])]).alias("sums")).collect()
    moved = centroids.copy()
    for row in found:
        moved[row["cluster"]] = [int(total) // row["n"] for total in row["sums"]]
    return moved


def _fitting_sum(distance: Column) -> Column:
    """The sum, NULL if it or a part of it is beyond 64 bits."""
    total = F.sum(distance.cast("decimal(38,0)"))
    return F.when((F.count(distance) == F.count(F.lit(1))) & (total <= LONG), total.cast("long"))


def cluster_vectors(table: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, vector: str = "embedding",
                    vec_id: str = "vec_id", dimensions: int = DIMENSIONS, scale: int = SCALE,
                    explained: float = EXPLAINED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Components become floor(scale * x). The first centroids are the ``k`` vectors whose
    ``seed:id`` has the smallest SHA-256; each of the ``rounds`` moves every centroid to the
    floor of its vectors' mean, then the vectors are assigned once more. Sums are whole
    numbers, so the result depends on neither tasks nor order. Only ``k`` centroids and
    their sums ever reach the driver.

    Vectors that are NULL, of another length, or hold NULL, NaN, infinity or a number
    beyond 64 bits once scaled take no part. Equal vectors agree; equal or NULL ids are
    rows of their own, a NULL id counts as the empty text in the choice of centroids, and
    equal ids are chosen by their vectors. With fewer than ``k`` vectors each is a centroid;
    an empty table gives no rows. A distance or a sum beyond 64 bits is NULL.
    """
    ids = F.col(vec_id)
    rows = materialise(table.filter(usable(F.col(vector), dimensions, scale)).select(
        ids.alias("vec_id"), F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * scale)).alias("q"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256).alias("place")))
    first = rows.orderBy("place", "q").limit(k).select("q").collect()
    made = ("vec_id " + rows.schema["vec_id"].dataType.simpleString()
            + ", cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not first:
        return table.sparkSession.createDataFrame([], made)
    centroids = np.array([r["q"] for r in first], dtype=np.int64)
    rotation = _rotation(rows, dimensions, explained)
    kept = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, q array<long>"
    stored = materialise(rows.select("vec_id", "q").mapInArrow(
        lambda batches: _rotated(batches, rotation), f"{kept}, led array<double>, rest double, whole double"))
    for _ in range(rounds):
        centroids = _moved(stored, centroids, rotation)

    labelled = materialise(stored.mapInArrow(
        lambda batches: _labelled(batches, centroids, rotation),
        f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"))
    digests = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    sums = labelled.groupBy("cluster").agg(_fitting_sum(F.col("distance")).alias("cluster_inertia"))
    inertia = labelled.agg(_fitting_sum(F.col("distance"))).first()[0]
    # k rows, whatever the number of vectors.
    about = sums.join(table.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    return labelled.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256")
