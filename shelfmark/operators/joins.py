"""Equi joins that survive a key holding a large share of the rows."""

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F

# Below this many sampled rows one task can hold any key, so nothing is hot.
MIN_SAMPLED_ROWS = 20_000
# What one part of a key may hold of all rows.
SHARE = 0.001


def hot_keys(df: DataFrame, key: str, share: float = SHARE, sample: float = 0.02,
             min_rows: int = MIN_SAMPLED_ROWS) -> dict:
    """Keys holding more than ``share`` of the rows, each with the number of parts to split it into.

    Parts are counted so that each holds about ``share`` of the rows; together that
    is at most 2/share parts. The key column of a sample is counted by key, combined
    in each task first, and only keys above the share come back: 1/share at most, NULL
    among them. The answer steers the physical plan alone: a missed or a superfluous
    key changes no result, so a sample is enough.
    """
    keys = df.select(F.col(key).alias("key"))
    if sample < 1.0:
        keys = keys.sample(fraction=sample, seed=17)
    total = keys.count()
    if total < max(min_rows, 1):
        return {}
    found = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share * total).collect()
    return {row["key"]: ceil(row["n"] / total / share) for row in found}


def fits_a_broadcast(df: DataFrame) -> bool:
    """Whether Spark expects ``df`` to be small enough to be sent to every executor."""
    threshold = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def skew_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
              hot: dict | None = None, salt: Sequence[str] = ()) -> DataFrame:
    """``fact`` joined to ``dim`` on ``key``, with the rows of hot keys spread out.

    ``hot`` maps the keys to spread to their number of parts; when it is not given
    they are looked for in ``fact``, unless ``dim`` fits a broadcast. ``fact`` should
    then be a table or a materialised frame, or the look repeats what makes it. Pass
    ``{}`` where the key is unique. Without hot keys this is the plain join, and Spark
    picks broadcast or sort-merge by size. Otherwise the ``fact`` rows of a hot key go
    to its parts by a hash of the ``salt`` columns and of the partition they come from:
    a retried task routes every row as before, equal rows of other partitions go other
    ways, and no column is read for it that the caller did not name. Only the ``dim``
    rows with a hot key are repeated, once per part. Filter ``fact`` before the join:
    Spark moves no filter below the parts.

    ``how`` may be inner, left, left_semi or left_anti: the joins in which every
    fact row meets all its partners within its own part. NULL keys match nothing; the
    joins that keep them spread them as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat rows")
    if hot is None:
        hot = {} if fits_a_broadcast(dim) else hot_keys(fact, key)
    if not hot:
        return fact.join(dim, key, how)

    # The hottest keys come first, so that looking up a row's parts ends early.
    ordered = sorted((k for k in hot if k is not None), key=hot.get, reverse=True)
    parts = F.lit(1)
    if ordered:
        parts_of = F.map_from_arrays(F.lit(ordered), F.lit([hot[k] for k in ordered]))
        parts = F.when(F.col(key).isin(ordered), F.try_element_at(parts_of, F.col(key))).otherwise(parts)
    if how in ("inner", "left_semi"):
        fact = fact.filter(F.col(key).isNotNull())
    elif None in hot:
        parts = F.when(F.col(key).isNull(), hot[None]).otherwise(parts)
    own_part = F.when(parts > 1, F.pmod(F.xxhash64(*salt, F.spark_partition_id()), parts).cast("int")).otherwise(0)
    salted = fact.withColumn("_part", own_part)
    repeated = dim.filter(F.col(key).isNotNull()).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.join(repeated, [key, "_part"], how).drop("_part")
