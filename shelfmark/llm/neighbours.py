"""Approximate nearest neighbours: multi-index hashing over learned rotated binary codes."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..checkpoints import materialise

#: Bits of a code and of each of the substrings that are indexed.
BITS, SUB_BITS = 128, 16
#: At most so many vectors are learnt from; so many of them serve to find the radius.
MAX_SAMPLE, RADIUS_QUERIES = 20_000, 256
#: Share of the sample's nearest neighbours that the radius takes in.
COVERED = 0.97
#: Rows that are indexed and queries that are searched together; a table has at least LEAST_BLOCKS blocks.
BLOCK, LEAST_BLOCKS = 8192, 32


@dataclass(frozen=True)
class Coder:
    """Codes: the signs of centred vectors after learned rotations, as 16-bit substrings."""
    mean: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    def code(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.mean) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(np.uint16)


def learn(sample: np.ndarray, k: int, seed: int = 3, rounds: int = 20) -> Coder:
    """Rotations that keep the principal components near to their signs, and a radius for ``k`` neighbours.

    Components are rotated at random, then signs and rotation are fitted to each other in
    turns. Several rotations give a code of ``BITS`` bits. The radius is the code distance
    that takes in ``COVERED`` of the ``k`` nearest neighbours within the sample; in the
    whole table neighbours are nearer, so it takes in more.
    """
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :BITS]
    projected = centred @ axes
    rotations = []
    while sum(r.shape[1] for r in rotations) < BITS:
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(projected.T @ np.sign(projected @ turn))
            turn = left @ right
        rotations.append(axes @ turn)
    coder = Coder(mean, np.concatenate(rotations, axis=1)[:, :BITS])
    some = sample[:RADIUS_QUERIES]
    codes = coder.code(sample)
    distances = []
    for i, query in enumerate(some):
        apart = ((sample - query) ** 2).sum(axis=1)
        apart[i] = np.inf
        near = np.argsort(apart, kind="stable")[:min(k, len(sample) - 1)]
        distances.append(np.bitwise_count(codes[near] ^ codes[i]).sum(axis=1))
    met = np.concatenate(distances) if distances else np.zeros(0)
    radius = int(np.ceil(np.quantile(met, COVERED))) if len(met) else BITS
    return Coder(coder.mean, coder.rotation, radius)


class SubstringIndex:
    """For each substring of the codes, the rows by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = [np.unique(codes[:, s], return_inverse=True) for s in range(codes.shape[1])]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) numbers of all codes within ``radius``.

        If no more than ``radius`` bits differ over m substrings, then some substring
        differs in at most ``radius // m`` bits, or, beyond the first ``radius % m + 1``
        substrings, in one bit fewer. So each table is probed for the values that near,
        and what they hold is compared in full.
        """
        near, over = divmod(radius, len(self.tables))
        found = np.zeros((len(queries), len(self.codes)), bool)
        for s, (values, row_values) in enumerate(self.tables):
            reach = near if s <= over else near - 1
            probed = np.bitwise_count(queries[:, s, None] ^ values) <= reach
            found |= probed[:, row_values]
        query, row = np.nonzero(found)
        apart = np.bitwise_count(queries[query] ^ self.codes[row]).sum(axis=1)
        return query[apart <= radius], row[apart <= radius]


def search(rows: np.ndarray, row_ids: np.ndarray, row_keys: np.ndarray, queries: np.ndarray, query_keys: np.ndarray,
           coder: Coder, k: int, step: int = 128) -> Iterator[pd.DataFrame]:
    """Of one block of rows, the ``k`` nearest to each query within the radius, by exact distance.

    A query that meets fewer than ``k`` rows has its radius widened until it meets ``k``
    or all. Ties go to the smaller id. A row is no candidate of itself.
    """
    index, codes = SubstringIndex(coder.code(rows)), coder.code(queries)
    for begin in range(0, len(queries), step):
        open_queries, radius = np.arange(begin, min(begin + step, len(queries))), coder.radius
        while len(open_queries):
            at, row = index.within(codes[open_queries], radius)
            other = query_keys[open_queries[at]] != row_keys[row]
            at, row = at[other], row[other]
            enough = np.bincount(at, minlength=len(open_queries)) >= k
            done = enough | (radius >= BITS)
            keep = done[at]
            query, row = open_queries[at[keep]], row[keep]
            score = np.concatenate([np.sqrt(((queries[query[c:c + 65536]] - rows[row[c:c + 65536]]) ** 2).sum(axis=1))
                                    for c in range(0, len(query), 65536)] or [np.zeros(0)])
            order = np.lexsort((row_keys[row], row_ids[row], score, query))
            query, row, score = query[order], row[order], score[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            best = place < k
            yield pd.DataFrame({"_query": query_keys[query[best]], "vec_id": row_ids[row[best]],
                                "_row": row_keys[row[best]], "score": score[best]})
            open_queries, radius = open_queries[~done], radius + max(BITS // 16, 1)


def usable(vector: Column) -> Column:
    """A vector that is not NULL or zero and holds nothing NULL or infinite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest(table: DataFrame, queries: Column | str, k: int = 10, vector: str = "embedding",
            vec_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows to each row that satisfies ``queries``.

    Every usable row is indexed, in blocks dealt by a hash; every block of rows meets every
    block of queries in a task of its own, which returns ``k`` rows for each query. Of
    these the nearest are kept. The coder is learnt from a sample of at most
    ``MAX_SAMPLE`` vectors.

    Vectors that are NULL, zero, hold NULL, NaN or infinity, or are of another length than
    most, take no part. Equal ids are rows of their own, and each query row is searched.
    A NULL id is no query unless the condition holds for it. With fewer than ``k`` other
    rows all are returned; an empty table gives no rows.
    """
    if isinstance(queries, str):
        queries = F.expr(queries)
    rows = materialise(table.filter(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("key")))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asking"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return table.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == usual["length"])
    coder = learn(_sample(rows, usual["rows"]), k)

    blocks = max(LEAST_BLOCKS, -(-usual["rows"] // BLOCK))
    query_blocks = max(1, -(-usual["asking"] // BLOCK))
    of_row = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    of_query = rows.filter("asks").withColumn(
        "query_block", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def matrix(vectors: pd.Series) -> np.ndarray:
        return np.stack(vectors.to_numpy()).astype(np.float64)

    def searched(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(asked):
            return pd.DataFrame({"_query": [], "vec_id": [], "_row": [], "score": []})
        found = pd.concat(search(matrix(some["vector"]), some["id"].to_numpy(), some["key"].to_numpy(),
                                 matrix(asked["vector"]), asked["key"].to_numpy(), coder, k))
        unknown = found["_row"].isin(some["key"][~some["known"]])
        return found.assign(vec_id=found["vec_id"].astype("Int64").mask(unknown))

    keys = ["block", "query_block"]
    # NULL ids come last, under a number, as pandas would turn all ids beside them into doubles.
    numbered = F.coalesce("id", F.lit((1 << 63) - 1)).alias("id")
    found = (of_row.select(numbered, F.col("id").isNotNull().alias("known"), "vector", "key", *keys).groupBy(*keys)
             .cogroup(of_query.select("vector", "key", *keys).groupBy(*keys))
             .applyInPandas(searched, "_query long, vec_id long, _row long, score double"))
    # Spark keeps the k best of each task before they meet.
    place = F.row_number().over(Window.partitionBy("_query").orderBy("score", "vec_id", "_row"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= k)
    asked = rows.filter("asks").select(F.col("key").alias("_query"), F.col("id").alias("query_id"))
    return best.join(asked, "_query").select("query_id", "rank", "vec_id", "score")


def _sample(rows: DataFrame, count: int) -> np.ndarray:
    """At most ``MAX_SAMPLE`` vectors, by the hash of their rows."""
    part = min(1.0, 1.2 * MAX_SAMPLE / max(count, 1))
    some = rows.filter(F.pmod(F.xxhash64("key", "id"), F.lit(1 << 31)) < int(part * (1 << 31)))
    chosen = some.orderBy(F.xxhash64("key", "id")).limit(MAX_SAMPLE).select("vector").toPandas()
    return np.stack(chosen["vector"].to_numpy()).astype(np.float64) if len(chosen) else np.zeros((0, 1))
