"""Kept results: where they lie, that they go, and fits that do not depend on cores."""

import os

import numpy as np
from pyspark.sql import functions as F

from shelfmark.checkpoints import checkpoint_dir, materialise, pin_partitions, scratch
from shelfmark.operators import clustering, reports as rp
from shelfmark.operators.recommend import RATINGS_PER_BLOCK, als_blocks
from shelfmark.sources import files


def local(path):
    return path.removeprefix("file:")


def test_scratch_leaves_nothing(spark):
    folder = local(checkpoint_dir(spark))
    before = set(os.listdir(folder))
    with scratch(spark):
        kept, pinned = materialise(spark.range(10)), pin_partitions(spark.range(10).repartition(3))
        assert kept.count() == pinned.count() == 10
        assert set(os.listdir(folder)) != before
    assert {n for n in os.listdir(folder) if os.listdir(f"{folder}/{n}")} <= before


def test_kept_partitions_do_not_depend_on_the_input(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    one, other = (clustering.fixed_partitions(rows.repartition(n), "id", 5).select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), "id") for n in (2, 9))
    assert one.collect() == other.collect()


def test_exact_quantiles_of_many_values(spark):
    rng = np.random.default_rng(0)
    values = np.round(rng.lognormal(3, 1, 120_000), 6)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    points = (0.0, 0.1, 0.5, 0.999, 1.0)
    got = rp.exact_quantiles(frame, "v", points, "q").first()["q"]
    ordered = np.sort(values)
    assert got == [ordered[max(int(np.ceil(p * len(ordered))), 1) - 1] for p in points]
    assert rp.exact_quantiles(frame.limit(0), "v", points, "q").first()["q"] == [None] * 5


def test_als_blocks_follow_the_ratings():
    assert als_blocks(1000) == 10 and als_blocks(250 * RATINGS_PER_BLOCK + 1) == 251


def test_als_blocks_are_no_more_than_memory_asks_for():
    """Vectors go to every block that rates them: 29 million ratings took 29 blocks, 173 million of rank 8 took 173."""
    assert als_blocks(29_000_000) == 10 and als_blocks(173_000_000, 8) == 11
    assert als_blocks(173_000_000, 50) == 44 and als_blocks(173_000_000, 200) > 100


def test_bulk_bodies(spark):
    lines = spark.range(0, 2345, 1, 3).select(F.concat(F.lit("a"), "id").alias("value"))
    bodies = files.bulk_batches(lines, 100).collect()
    assert all(b["documents"] == len(b["value"].split("\n")) <= 100 for b in bodies)
    assert sorted(line for b in bodies for line in b["value"].split("\n")) == sorted(f"a{i}" for i in range(2345))
