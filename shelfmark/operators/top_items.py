"""Exact top-k items per user by inner product, pruned by the items' distances from their mean.

An item is its mean and a deviation; deviations are measured by their own covariance, so
that one length means the same in all directions. The score of a pair is at most that of
the mean, plus the product of the user's and the deviation's lengths. The farthest items
are scored for everybody first, which gives each user a floor: the score of the k-th item
so far. The other items lie in blocks of falling length, and a user needs those blocks
alone whose farthest item could still reach the floor, which rises as blocks are scored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..checkpoints import materialise

#: Farthest items, scored for every user: all that is sent to every task (13 MB at 50 coordinates).
HEAD = 32_768
#: Other items per block, and users per group to whom the blocks are sent.
ITEMS, USERS = 16_384, 16_384
#: Blocks at most; beyond, blocks grow.
MAX_BLOCKS = 4096
#: Groups for each core; beyond, groups grow, so that what is sent grows with the items, up to the users a task can hold.
GROUPS_PER_CORE, MOST_USERS = 2, 262_144
#: More than rounding to single precision and sums in another order can change of a product of lengths.
SLACK = 1e-6
#: Items in one matrix product, pairs in one; items in one row that is sent, 10,000 of which may meet in one Arrow batch.
CHUNK, PAIRS, ROW = 2048, 1 << 20, 32
#: Candidates whose scores are added up at once.
FOUND = 1 << 14
NOBODY = np.iinfo(np.int64).max


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, width))


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors ** 2).sum(axis=1))


@dataclass(frozen=True)
class Shape:
    """Where the items lie: their mean, and a triangle of which they are multiples from there."""
    mean: np.ndarray
    triangle: np.ndarray

    @classmethod
    def of(cls, count: int, total: np.ndarray, squares: np.ndarray) -> "Shape":
        """From the number of items, their sum, and the sum of their products by pairs of coordinates."""
        width = len(total)
        with np.errstate(all="ignore"):
            mean = total / max(count, 1)
            spread = squares / max(count, 1) - np.outer(mean, mean)
            most = np.trace(spread)
            # No direction counts as flatter than a thousandth of the whole.
            spread = spread + np.eye(width) * (most * 1e-6 if most > 0 else 1.0)
        try:
            triangle = np.linalg.cholesky(spread)
        except np.linalg.LinAlgError:
            triangle = np.full((width, width), np.nan)
        if not np.isfinite(triangle).all() or not np.isfinite(mean).all():
            return cls(np.zeros(width), np.eye(width))      # the lengths of the vectors themselves
        return cls(mean, triangle)

    def far(self, items: np.ndarray) -> np.ndarray:
        """The length of each item's deviation."""
        return lengths_of(np.linalg.solve(self.triangle, (items - self.mean).T).T) if len(items) else np.zeros(0)

    def reach(self, users: np.ndarray) -> np.ndarray:
        """By how much a user's score of an item can differ from that of the mean, for each unit of its length."""
        return lengths_of(users @ self.triangle)

    def still(self, users: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """What is left of the users' floors for a deviation to make up, less what rounding can change."""
        floor = floor.astype(np.float64)
        with np.errstate(invalid="ignore"):
            return floor - SLACK * np.abs(floor) - users @ self.mean - SLACK * lengths_of(users) * np.sqrt(
                (self.mean ** 2).sum())


class Best:
    """The ``k`` best items of each of some users so far."""

    def __init__(self, vectors: np.ndarray, k: int, shape: Shape):
        n = len(vectors)
        self.vectors, self.k, self.shape, self.lengths = vectors, k, shape, lengths_of(vectors)
        self.reach = shape.reach(vectors)
        self.ids = np.full((n, k), NOBODY)
        self.scores = np.full((n, k), -np.inf, np.float32)
        self.floor = np.full(n, -np.inf, np.float32)
        self.left = np.full(n, -np.inf)
        within = self.lengths[self.lengths > 0]
        # Single precision is enough to find candidates, where it neither over- nor underflows.
        self.single = not len(within) or 1e-15 < within.min() and within.max() < 1e15

    def take(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Set the best of the users ``at``."""
        self.ids[at], self.scores[at] = ids, scores
        full = self.ids[at, -1] < NOBODY
        self.floor[at] = np.where(full, self.scores[at, -1], -np.inf)
        self.left[at] = self.shape.still(self.vectors[at], self.floor[at])

    def offer(self, ids: np.ndarray, items: np.ndarray, far: float) -> None:
        """Score items, none of which deviates further than ``far``, for the users whose floor they could reach.

        One matrix product finds the candidates; their scores are then added up coordinate
        by coordinate, so that a score does not depend on who else is in the product. Scores
        have single precision; ties go to the smaller id.
        """
        if not len(ids):
            return
        lengths = lengths_of(items)
        longest, within = lengths.max(), lengths[lengths > 0]
        single = self.single and (not len(within) or 1e-15 < within.min() and longest < 1e15)
        kind, slack = (np.float32, SLACK + (items.shape[1] + 4) * 2.0 ** -24) if single else (np.float64, SLACK)
        across = np.ascontiguousarray(items.T, kind)
        wanting = np.flatnonzero((self.lengths > 0) & (self.left <= self.reach * far * (1 + SLACK)))
        step = max(1, PAIRS // len(ids))
        products = np.empty((min(step, len(wanting)), len(ids)), kind)
        for begin in range(0, len(wanting), step):
            at = wanting[begin:begin + step]
            rough = np.matmul(self.vectors[at].astype(kind), across, out=products[:len(at)])
            cut = self.floor[at].astype(np.float64)
            none = np.flatnonzero(cut == -np.inf)
            if len(none) and len(ids) > self.k:
                cut[none] = np.partition(rough[none], len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            cut -= slack * longest * self.lengths[at]
            # To the next number below, so that a comparison in single precision drops nothing.
            cut = np.nextafter(cut.astype(kind), kind(-np.inf))
            # Soon most users find nothing in most products, which their best score tells; what is not a number is looked at.
            some = np.flatnonzero(~(rough.max(axis=1) < cut))
            found = np.flatnonzero(rough[some] >= cut[some, None])
            if not len(found):
                continue
            user, item = np.divmod(found, len(ids))
            user = some[user]
            # A running sum, so in the order of the coordinates.
            score = np.concatenate([np.cumsum(self.vectors[at[user[i:i + FOUND]]] * items[item[i:i + FOUND]], axis=1)[:, -1]
                                    for i in range(0, len(user), FOUND)]).astype(np.float32)
            keep = score >= self.floor[at[user]]
            if keep.any():
                self._merge(at, user[keep], ids[item[keep]], score[keep])

    def _merge(self, at: np.ndarray, user: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        met, user = np.unique(user, return_inverse=True)
        at = at[met]
        user = np.concatenate([np.repeat(np.arange(len(met)), self.k), user])
        ids = np.concatenate([self.ids[at].ravel(), ids])
        scores = np.concatenate([self.scores[at].ravel(), scores])
        order = np.lexsort((ids, -scores, ids == NOBODY, user))
        first = order[np.searchsorted(user[order], np.arange(len(met)))[:, None] + np.arange(self.k)]
        self.take(at, ids[first], scores[first])

    def lists(self) -> tuple[list, list]:
        kept = (self.ids < NOBODY).sum(axis=1)
        return ([row[:n].tolist() for row, n in zip(self.ids, kept)],
                [row[:n].tolist() for row, n in zip(self.scores, kept)])


def blocks_needed(lengths: np.ndarray, floor: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """How many blocks, of falling longest item, could hold an item that reaches the floor."""
    with np.errstate(divide="ignore", invalid="ignore"):
        least = floor.astype(np.float64) / (lengths * (1 + SLACK))
    return np.where(lengths > 0, np.searchsorted(-longest, -least, side="right"), 0)


@dataclass(frozen=True)
class TopItems:
    """``rows``: (user, item, score), ``k`` for each user or all items. ``effort``: what was scored at most, in one row."""
    rows: DataFrame
    effort: DataFrame


def shape_of(items: DataFrame, width: int) -> Shape:
    """From sums that each task makes of its items: one row a task reaches the driver."""
    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total, squares = 0, np.zeros(width), np.zeros((width, width))
        with np.errstate(all="ignore"):
            for batch in batches:
                vectors = matrix(batch["features"], width)
                count, total, squares = count + len(vectors), total + vectors.sum(axis=0), squares + vectors.T @ vectors
        yield pd.DataFrame({"count": [count], "total": [total.tobytes()], "squares": [squares.tobytes()]})

    parts = items.select("features").mapInPandas(summed, "count long, total binary, squares binary").collect()
    with np.errstate(all="ignore"):
        return Shape.of(sum(p["count"] for p in parts), sum((np.frombuffer(p["total"]) for p in parts), np.zeros(width)),
                        sum((np.frombuffer(p["squares"]).reshape(width, width) for p in parts), np.zeros((width, width))))


def top_items(users: DataFrame, items: DataFrame, k: int, head: int = HEAD, block_items: int = ITEMS,
              group_users: int = USERS) -> TopItems:
    """The ``k`` items of the greatest inner product for each user; both frames are (id, features).

    Users are grouped by the number of blocks they need, so most groups meet few blocks.
    Each group is one task's, to which the blocks come in order of falling length: users
    move once, items once for each group that needs them. Groups have ``group_users`` each
    or, where that would make more than ``GROUPS_PER_CORE`` for each core, more users.

    Ids are whole numbers, each of one row. Rows without id or features, or with a
    length that is not finite, take no part; all vectors have the same number of
    coordinates. A user of length zero scores 0 with every item and gets the smallest
    ids. Ties go to the smaller id.
    """
    spark = users.sparkSession
    length = F.sqrt(F.aggregate(F.col("features").cast("array<double>"), F.lit(0.0), lambda a, v: a + v * v))

    def usable(frame: DataFrame) -> DataFrame:
        return (frame.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"),
                             length.alias("length"))
                .filter("id IS NOT NULL AND NOT isnan(length) AND length < double('inf')"))

    users, items = usable(users), materialise(usable(items))
    count = items.count()
    one = items.select("features").first()
    width = len(one["features"]) if one else 0
    shape = shape_of(items, width)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(length=shape.far(matrix(batch["features"], width)))

    items = materialise(items.mapInPandas(measured, "id long, features array<double>, length double"))
    n_blocks = min(MAX_BLOCKS, -(-max(count - head, 0) // block_items))
    by_length = (F.desc("length"), F.col("id"))
    # At most ``head`` rows of one length of vector, whatever the number of items.
    first = items.orderBy(*by_length).limit(head).toPandas()
    first_items, first_ids = matrix(first["features"], width), first["id"].to_numpy(np.int64)
    first_far = first["length"].to_numpy(np.float64)
    smallest = np.sort(np.array([r["id"] for r in items.select("id").orderBy("id").limit(k).collect()], np.int64))
    longest = np.zeros(0)
    if n_blocks:
        last = first.iloc[-1]
        rest = items.filter((F.col("length") < float(last["length"]))
                            | ((F.col("length") == float(last["length"])) & (F.col("id") > int(last["id"]))))
        rest = materialise(rest.repartitionByRange(n_blocks, *by_length).sortWithinPartitions(*by_length)
                           .withColumn("block", F.spark_partition_id()).mapInPandas(_packed, PACKED))
        # One row per block; a block that the ranges left empty has none.
        met = {r["block"]: (r["far"], r["n"]) for r in rest.groupBy("block").agg(
            F.max("far").alias("far"), F.sum("n").alias("n")).collect()}
        longest = np.array([met[b][0] for b in sorted(met)])
        sizes = np.cumsum([0] + [met[b][1] for b in sorted(met)])
        numbers = spark.createDataFrame([(b, i) for i, b in enumerate(sorted(met))], "block int, number int")
        rest = rest.join(F.broadcast(numbers), "block").drop("block").withColumnRenamed("number", "block")
    shared = spark.sparkContext.broadcast((first_items, first_ids, first_far, smallest, longest, shape))

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each user's best among the farthest items, and the number of blocks still needed."""
        first_items, first_ids, first_far, smallest, longest, shape = shared.value
        for batch in batches:
            vectors = matrix(batch["features"], width)
            best = Best(vectors, k, shape)
            begin, end = 0, CHUNK
            while begin < len(first_ids):       # few at first, which give a floor to the many that follow
                best.offer(first_ids[begin:end], first_items[begin:end], first_far[begin])
                begin, end = end, 4 * end
            found, scores = best.lists()
            for i in np.flatnonzero(best.lengths == 0):
                found[i], scores[i] = smallest.tolist(), [0.0] * len(smallest)
            yield pd.DataFrame({"user": batch["id"], "features": batch["features"], "items": found, "scores": scores,
                                "blocks": blocks_needed(best.reach * (best.lengths > 0), best.left, longest)})

    after = materialise(users.repartition(GROUPS_PER_CORE * spark.sparkContext.defaultParallelism, "id").mapInPandas(
        opened, "user long, features array<double>, items array<long>, scores array<float>, blocks int")
        if width else users.select(F.col("id").alias("user"), "features", F.expr("cast(array() AS array<long>) AS items"),
                                   F.expr("cast(array() AS array<float>) AS scores"), F.lit(0).alias("blocks")))
    rows = after.filter("blocks = 0").select(
        "user", F.inline(F.arrays_zip(F.col("items").alias("item"), F.col("scores").alias("score"))))
    scored = F.lit(len(first_ids)).cast("long")
    if n_blocks:
        rows = rows.unionByName(_from_blocks(after.filter("blocks > 0"), rest, k, width, group_users, shape))
        if not after.groupBy("user").count().filter("count > 1").isEmpty():
            # Users of one id share a list.
            best = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("score"), "item"))
            rows = rows.withColumn("_place", best).filter(F.col("_place") <= k).drop("_place")
        scored = scored + F.element_at(F.lit([int(s) for s in sizes]), F.col("blocks") + 1)
    effort = after.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.sum(scored), F.lit(0)).alias("scored")).select(
        "users", F.lit(count).cast("long").alias("items"), (F.col("users") * count).alias("pairs"), "scored")
    return TopItems(rows, effort)


#: Items of one block as bytes, whose vectors take four bytes a coordinate where that loses nothing.
PACKED = "block int, n int, far double, ids binary, vectors binary"


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for begin in range(0, len(batch), ROW):
            some = batch.iloc[begin:begin + ROW]
            vectors = matrix(some["features"], 0)
            with np.errstate(over="ignore"):
                short = vectors.astype(np.float32)
            yield pd.DataFrame({"block": some["block"].iloc[:1].to_numpy(), "n": [len(some)], "far": [some["length"].max()],
                                "ids": [some["id"].to_numpy(np.int64).tobytes()],
                                "vectors": [(short if (short == vectors).all() else vectors).tobytes()]})


def _unpacked(row, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    kind = np.float32 if len(row.vectors) == 4 * len(ids) * width else np.float64
    return ids, np.frombuffer(row.vectors, kind).reshape(len(ids), width).astype(np.float64)


def _from_blocks(users: DataFrame, items: DataFrame, k: int, width: int, group_users: int, shape: Shape) -> DataFrame:
    """The best of all items for users that still need blocks, grouped by the number of blocks."""
    count, cores = users.count(), users.sparkSession.sparkContext.defaultParallelism
    n_groups = max(1, -(-count // MOST_USERS), min(-(-count // group_users), GROUPS_PER_CORE * cores))
    grouped = materialise(users.repartitionByRange(n_groups, F.desc("blocks"), "user")
                          .withColumn("group", F.spark_partition_id()))
    # One row per group, so a list of pairs (group, block) that grows with the number of groups.
    deepest = grouped.groupBy("group").agg(F.max("blocks").alias("deepest"))
    wanted = deepest.select("group", F.explode(F.sequence(F.lit(0), F.col("deepest") - 1)).alias("block"))
    # Users come before the blocks, blocks in order of falling length.
    sent = grouped.select("group", F.lit(-1).alias("block"), "user", "features", "items", "scores").unionByName(
        items.join(F.broadcast(wanted), "block").select("group", "block", "far", "n", "ids", "vectors"),
        allowMissingColumns=True)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows of a partition: of each group the users, then the blocks."""
        group, asking, best, held, kept = None, [], None, [], 0

        def met() -> Best:
            """The users of the group, with what they have found."""
            vectors, ids, scores = (np.concatenate([a[i] for a in asking]) for i in (1, 2, 3))
            found = Best(vectors, k, shape)
            found.take(np.arange(len(vectors)), ids, scores)
            return found

        def offered() -> None:
            if held:
                chunks = [_unpacked(row, width) for row in held]
                best.offer(np.concatenate([c[0] for c in chunks]), np.concatenate([c[1] for c in chunks]),
                           max(row.far for row in held))

        def found() -> Iterator[pd.DataFrame]:
            names = np.concatenate([a[0] for a in asking])
            for begin in range(0, len(names), 1 << 14):
                ids, scores = best.ids[begin:begin + (1 << 14)], best.scores[begin:begin + (1 << 14)]
                user, place = np.nonzero(ids < NOBODY)
                yield pd.DataFrame({"user": names[begin + user], "item": ids[user, place], "score": scores[user, place]})

        for batch in batches:
            for number, rows in batch.groupby("group", sort=True):
                if number != group:
                    if best is not None:
                        offered()
                        yield from found()
                    group, asking, best, held, kept = number, [], None, [], 0
                some = rows[rows["block"] < 0]
                if len(some):
                    ids, scores = np.full((len(some), k), NOBODY), np.full((len(some), k), -np.inf, np.float32)
                    for i, (items, reached) in enumerate(zip(some["items"], some["scores"])):
                        ids[i, :len(items)], scores[i, :len(items)] = items, reached
                    asking.append((some["user"].to_numpy().astype(np.int64), matrix(some["features"], width), ids, scores))
                for row in rows[rows["block"] >= 0].itertuples():
                    best = met() if best is None else best
                    held.append(row)
                    kept += int(row.n)
                    if kept >= CHUNK:
                        offered()
                        held, kept = [], 0
        if best is not None:
            offered()
            yield from found()

    return sent.repartitionById(n_groups, "group").sortWithinPartitions(
        "group", "block", F.desc("far")).mapInPandas(scored, "user long, item long, score float")
