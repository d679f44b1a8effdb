"""Connected components of links, without bringing them to the driver."""

from pyspark.sql import DataFrame, functions as F

from ..checkpoints import materialise


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) as (node, root): the smallest node each linked node can reach.

    Alternates two steps until nothing changes: every node hands its larger neighbours to
    its smallest one, then every node hands its smaller neighbours to its smallest one.
    Chains shorten by half each round, stars stay stars, and the number of links never
    grows. A node met by very many others is split: smallest neighbours are combined in
    each task before they meet, and the join that follows is one Spark can split.
    Each round is written to the checkpoint folder.
    """
    edges = materialise(links.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct())
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = materialise(_to_smallest(both).filter("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        smaller = large.filter("a > b")
        small = materialise(_to_smallest(smaller).select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("low").alias("b")).filter("a <> b").distinct())
        # Both are sets: equal sizes and nothing new means that they are the same.
        if small.count() == edges.count() and small.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
        edges = small
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _to_smallest(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) with ``low``, the smallest of ``a`` and its neighbours."""
    lows = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return edges.join(lows, "a")
