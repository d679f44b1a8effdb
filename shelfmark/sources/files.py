"""Readers and writers for the formats of the curated data, reports and exports."""

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

HASH_SPAN = 2 ** 64


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a path, folder or glob; malformed lines give NULL columns."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A stored frame over all cores, if it comes in fewer partitions than there are.

    For work on each text by itself, which costs far more than moving a few texts and
    gives the same rows wherever it runs. A large table has more partitions than cores
    and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small frame from Python rows: a lexicon, a metrics line. Through Arrow, so that Spark knows its size."""
    types = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    named = [dict(zip(types.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema=to_arrow_schema(types)), types)


# ------------------------------------------------------------------- samples

def sample_rows(df: DataFrame, n: int, key: Sequence[str], place: Column | None = None) -> DataFrame:
    """``n`` rows picked by the hash of their key, or all when there are fewer.

    The same rows come out on every run; rows with equal keys are told apart by all their
    columns. Spark keeps ``n`` rows of each task. A bound on the hash, some four times as
    wide as needed, drops nearly everything inside the scan first; should repeated keys
    leave fewer than ``n`` rows below it, the bound is not used. ``place`` is a column of
    own choice to pick by, smallest first.
    """
    every = [F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    if place is not None:
        return df.orderBy(place, *key, *every).limit(n)
    place = F.xxhash64(*key)
    bound = -HASH_SPAN // 2 + HASH_SPAN * (4 * n + 1000) // max(df.count(), 1)
    if bound < HASH_SPAN // 2:
        below = df.filter(place < F.lit(bound))
        if below.select(*key).count() >= n:
            df = below
    return df.orderBy(place, *key, *every).limit(n)


def export_sample(df: DataFrame, n: int, path: str, key: Sequence[str] = (),
                  order_by: Sequence[Column | str] = ()) -> None:
    """At most ``n`` rows as a single JSON file: the first by ``order_by``, or a sample by ``key``."""
    rows = df.orderBy(*order_by).limit(n) if order_by else sample_rows(df, n, key)
    write_json(rows.coalesce(1), path)


# ---------------------------------------------------------- search-index lines

def bulk_index_lines(df: DataFrame, index: str, id_col: str = "book_id",
                     doc_cols: Sequence[str] = ("title", "description", "average_rating",
                                                "similar_books")) -> DataFrame:
    """Per row, one ``value`` of two lines: the index action and the document."""
    keep_nulls = {"ignoreNullFields": "false"}
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"),
                                         F.col(id_col).alias("_id")).alias("index")), keep_nulls)
    document = F.to_json(F.struct(*doc_cols), keep_nulls)
    return df.select(F.concat(action, F.lit("\n"), document).alias("value"))


def bulk_batches(lines: DataFrame, docs_per_batch: int = 500) -> DataFrame:
    """(batch, documents, value): the lines of at most ``docs_per_batch`` documents as one request body.

    500 documents are the 1,000 lines of a usual request. A task numbers its own rows, so
    batches are filled task by task and no row leaves its batch for another task's.
    """
    number = F.monotonically_increasing_id()
    rows = lines.select("value", F.spark_partition_id().alias("_part"), number.alias("_row"))
    batch = F.concat_ws("-", "_part", F.floor((F.col("_row") - F.shiftleft(F.col("_part").cast("long"), 33))
                                              / docs_per_batch))
    return (rows.groupBy(batch.alias("batch"))
            .agg(F.count(F.lit(1)).alias("documents"),
                 F.array_sort(F.collect_list(F.struct("_row", "value"))).alias("_lines"))
            .select("batch", "documents", F.array_join(F.transform("_lines", lambda r: r["value"]), "\n").alias("value")))


def write_bulk_lines(lines: DataFrame, path: str, docs_per_batch: int = 500, docs_per_file: int | None = None) -> None:
    """Bulk request bodies as JSON rows in files of normal size; or, with ``docs_per_file``, as text files to post."""
    if docs_per_file:
        lines.write.mode("overwrite").option("maxRecordsPerFile", docs_per_file).text(path)
    else:
        write_json(bulk_batches(lines, docs_per_batch), path)


# ------------------------------------------------------------------ inspection

def profile_table(df: DataFrame, n: int = 5, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(columns with their types, the first ``n`` rows, by ``key`` if given, the row count)."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = literal_rows(df.sparkSession, fields, "position int, column string, type string, nullable boolean")
    return schema, (df.orderBy(*key) if key else df).limit(n), df.agg(F.count(F.lit(1)).alias("row_count"))
