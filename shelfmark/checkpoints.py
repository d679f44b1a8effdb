"""Results kept in the folder the cluster names, their lineage cut."""

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session without one gets a folder of its warehouse, which is shared as well."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/kept-results"
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once into a Parquet table that later jobs read, by column.

    A lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/materialised-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin_partitions(df: DataFrame) -> DataFrame:
    """``df`` checkpointed: as ``materialise``, but every row stays in its partition, in order."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, by the file system it is in."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is kept or checkpointed within this block is removed at its end: results must be written by then."""
    context, before = spark.sparkContext, checkpoint_dir(spark)
    own = f"{before}/job-{uuid4().hex}"
    context.setCheckpointDir(own)
    try:
        yield
    finally:
        remove(spark, own)
        context.setCheckpointDir(before)
