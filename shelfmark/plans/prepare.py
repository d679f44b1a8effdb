"""Raw JSON lines to the curated datasets and their JSON samples."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import etl
from ..operators.joins import hot_keys
from ..operators.reports import key_uniqueness
from ..schemas import RAW_BOOKS, RAW_REVIEWS
from ..sources import files

SAMPLE_ROWS = 50_000


def run(spark: SparkSession, source: str, out: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Read ``*books*.json`` and ``*reviews*.json`` under ``source``; returns the row counts.

    Parsing JSON costs most, so each file is parsed once, into ``staged`` Parquet.
    The two joins then read only the columns they deliver, and both use the hot
    books found in one look at the key column.
    """
    files.write_parquet(etl.normalize_books(files.read_json(spark, f"{source}/*books*.json", RAW_BOOKS)),
                        f"{out}/staged/books")
    files.write_parquet(etl.normalize_reviews(files.read_json(spark, f"{source}/*reviews*.json", RAW_REVIEWS)),
                        f"{out}/staged/reviews")
    books = files.read_parquet(spark, f"{out}/staged/books")
    reviews = files.read_parquet(spark, f"{out}/staged/reviews")

    hot = hot_keys(reviews, "book_id")
    for subset, needed, place in ((etl.nlp_subset, etl.with_text, "nlp"), (etl.rec_subset, etl.with_rating, "recommender")):
        files.write_parquet(subset(etl.reviews_with_books(needed(reviews), books, hot=hot)), f"{out}/{place}/parquet")
    files.write_parquet(etl.eda_subset(books), f"{out}/eda/parquet")

    nlp = files.read_parquet(spark, f"{out}/nlp/parquet")
    eda = files.read_parquet(spark, f"{out}/eda/parquet")
    files.export_sample(nlp, sample_rows, f"{out}/nlp/sample_json", key=["book_id", "user_id"])
    files.export_sample(eda, sample_rows, f"{out}/eda/sample_json", key=["book_id"])

    # The join's size follows from the counts of either side by book.
    per_book = [side.filter("book_id IS NOT NULL").groupBy("book_id").agg(F.count(F.lit(1)).alias(name))
                for side, name in ((reviews, "n_reviews"), (books, "n_books"))]
    joined = per_book[0].join(per_book[1], "book_id").agg(
        F.lit("joined reviews").alias("what"),
        F.coalesce(F.sum(F.col("n_reviews") * F.col("n_books")), F.lit(0)).alias("rows"))
    # More rows than distinct keys among the books would multiply reviews.
    keys = key_uniqueness(books.filter(F.col("book_id").isNotNull()), "book_id")
    return joined.unionByName(keys.select(F.inline(F.array(
        F.struct(F.lit("books").alias("what"), F.col("total_rows").alias("rows")),
        F.struct(F.lit("distinct books").alias("what"), F.col("distinct_keys").alias("rows"))))))
