"""Catalogue documents as bulk request bodies for a search index."""

from pyspark.sql import SparkSession

from ..sources import files


def run(spark: SparkSession, source: str, out: str, index: str = "catalogue", docs_per_batch: int = 500,
        docs_per_file: int | None = None) -> None:
    """Write one action line and one document line per book, as rows of request bodies or files to post."""
    files.write_bulk_lines(files.bulk_index_lines(files.read_parquet(spark, source), index), out, docs_per_batch,
                           docs_per_file)
