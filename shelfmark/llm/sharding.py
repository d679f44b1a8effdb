"""Contiguous shards of near-equal byte size, cut along global prefix sums."""

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..checkpoints import materialise

#: Bytes that every row takes besides its text.
OVERHEAD = 8


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the task's number and the bytes and rows of the task that come before each row."""
    part, size, rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sums = batch["_size"].cumsum()
        yield batch.assign(_part=part, _bytes=sums - batch["_size"] + size, _row=range(rows, rows + len(batch)))
        if len(batch):
            size, rows = size + int(sums.iloc[-1]), rows + len(batch)


def cut_shards(docs: DataFrame, shards: int, order: Sequence[str] = ("doc_id",), text: str = "text",
               overhead: int = OVERHEAD, keep: Sequence[str] = ()) -> DataFrame:
    """``docs`` in the order of ``order``, cut into ``shards`` runs of near-equal byte size.

    Returns the ``order`` and ``keep`` columns with ``size`` (UTF-8 bytes of the text and
    ``overhead``), ``text_crc32``, ``shard`` from 0 and ``slot``, the row's place in its shard.

    The rows are range-partitioned by ``order``, without their texts unless ``keep`` names
    them. Each task adds up its own sizes; the totals of the tasks, one row each, give
    every task its global offset. A row belongs to the shard in which its middle byte
    lies, so a shard misses its target by at most one row at either end. Rows with equal
    ``order`` come by the hash of their text, then in the order of the input, so equal
    rows are split over tasks and shards as others are.

    A NULL text counts as empty, NULL keys come first, an empty table gives no rows. A
    row longer than a target leaves shards without rows.
    """
    columns = list(dict.fromkeys([*order, *keep]))
    place = [f"_order{i}" for i in range(len(order))]
    rows = docs.select(
        *[F.col(c).alias(f"_kept{i}") for i, c in enumerate(columns)],
        *[F.col(c).alias(p) for c, p in zip(order, place)],
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("_size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("_crc"),
        F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_input"))
    place += ["_hash", "_input"]
    ranged = rows.repartitionByRange(*place).sortWithinPartitions(*place).drop(*place)
    added = _widened(ranged, "_part int, _bytes long, _row long")
    ordered = materialise(ranged.mapInPandas(_running, added))

    totals = ordered.groupBy("_part").agg(F.sum("_size").alias("_all"), F.count(F.lit(1)).alias("_count"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the range partitioning, whatever the number of documents.
    offsets = totals.select("_part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_bytes_before"),
                            F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_rows_before"))
    total = ordered.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    middle = F.col("_bytes") + F.col("_bytes_before") + F.col("_size") / 2
    placed = ordered.join(F.broadcast(offsets), "_part").select(
        *[c for c in ordered.columns if c.startswith("_kept")], "_size", "_crc",
        F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int").alias("_shard"),
        (F.col("_row") + F.col("_rows_before")).alias("_at"))
    starts = placed.groupBy("_shard").agg(F.min("_at").alias("_first"))     # one row per shard
    return placed.join(F.broadcast(starts), "_shard").select(
        *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(columns)], F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"),
        (F.col("_at") - F.col("_first")).alias("slot"))


def _widened(df: DataFrame, added: str) -> str:
    """The DDL of ``df`` with more columns."""
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [added])


def write_shards(docs: DataFrame, path: str, shards: int, order: Sequence[str] = ("doc_id",),
                 text: str = "text", folder: str = "_shard") -> None:
    """All columns of ``docs`` as Parquet, a folder ``folder``=number for each shard."""
    # Other names for the while, as those of the result may be among them.
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    cut = cut_shards(docs.toDF(*names.values()), shards, [names[c] for c in order], names[text], keep=names.values())
    rows = cut.select(*[F.col(new).alias(old) for old, new in names.items()], F.col("shard").alias(folder))
    rows.write.partitionBy(folder).parquet(path)
