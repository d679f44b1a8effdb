"""The roles catalogue, ratings and reviews, read from star-schema tables.

Parts are the catalogue, line items the ratings given by the ordering customers,
documents the texts. Each view reads only the tables and columns it needs.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import hot_keys, skew_join
from .files import spread

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# SQL for 0 (no rating) to 5 from a quantity of 1 to 50.
RATING = "int(floor(l_quantity / 10))"


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Books from parts alone, with arrays made from the row's own columns.

    Promotional parts have no ``series`` and small ones no ``similar_books``. The
    others are similar to the first part of their block of 100 and to up to 49
    parts that follow them in the catalogue.
    """
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS book_id",
        "p_name AS title",
        "array(struct(p_brand AS author_id, 'Author' AS role)) AS authors",
        "concat_ws(' ', p_brand, p_type) AS description",
        "(p_size - 1) * 20 AS num_pages",
        "CASE WHEN p_type <> 'PROMO' THEN array_repeat(p_brand, p_size % 6) END AS series",
        """CASE WHEN p_type = 'SMALL' THEN NULL
                WHEN p_size = 1 THEN cast(array() AS array<bigint>)
                ELSE concat(array(p_partkey - p_partkey % 100),
                            sequence(p_partkey + 1, p_partkey + p_size - 1)) END AS similar_books""")


def rated_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue with the average and number of its ratings.

    Line items are counted per part before they meet the parts, so a part that
    holds a large share of them is one row by then.
    """
    stats = (table(spark, folder, "lineitem")
             .selectExpr("l_partkey AS book_id", "l_returnflag", f"nullif({RATING}, 0) AS given")
             .groupBy("book_id")
             .agg(F.expr("avg(given) AS average_rating"), F.expr("int(count(given)) AS ratings_count"),
                  F.expr("int(count_if(l_returnflag = 'R')) AS text_reviews_count")))
    return catalogue(spark, folder).join(stats, "book_id", "left")


def shelves(spark: SparkSession, folder: str) -> DataFrame:
    """(book_id, popular_shelves): the supplying nations of each part and how often each did.

    The count per part and nation comes first, so what is collected per part is
    at most one entry per nation (25 in this schema at any scale).
    """
    lines = table(spark, folder, "lineitem").selectExpr("l_partkey AS book_id", "l_suppkey AS s_suppkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").selectExpr("n_nationkey AS s_nationkey", "lower(n_name) AS name")
    return (skew_join(lines, suppliers, "s_suppkey")
            .groupBy("book_id", "s_nationkey").agg(F.expr("string(count(1)) AS count"))
            .join(nations, "s_nationkey")
            .groupBy("book_id")
            .agg(F.expr("sort_array(collect_list(struct(count, name))) AS popular_shelves")))


def shelved_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue(spark, folder).join(shelves(spark, folder), "book_id", "left")


def full_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return rated_catalogue(spark, folder).join(shelves(spark, folder), "book_id", "left")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Review rows without text: every line item with the customer who ordered it."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_partkey AS book_id", f"{RATING} AS rating", "l_linenumber AS n_votes")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # An order has a few lines: its key is never hot.
    return skew_join(lines, orders, "o_orderkey", hot={}).selectExpr(
        "book_id", "o_custkey AS user_id", "rating", "n_votes",
        "string(date(o_orderdate)) AS date_added")


def hot_books(spark: SparkSession, folder: str) -> dict:
    """Parts with a large share of the line items, found in the table itself."""
    return hot_keys(table(spark, folder, "lineitem"), "l_partkey")


def titled_ratings(spark: SparkSession, folder: str) -> DataFrame:
    given = ratings(spark, folder).select("user_id", "book_id", "rating")
    titles = table(spark, folder, "part").select(F.col("p_partkey").alias("book_id"),
                                                 F.col("p_name").alias("title"))
    return skew_join(given, titles, "book_id", hot=hot_books(spark, folder))


def texts(spark: SparkSession, folder: str, costly: bool = False) -> DataFrame:
    """Documents as described books; over all cores when the work on each text is ``costly``."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("book_id"), F.col("source").alias("title"), F.col("text").alias("description"))
    return spread(documents) if costly else documents


def unrated_reviews(spark: SparkSession, folder: str, costly: bool = False) -> DataFrame:
    """Documents as reviews of the part with their number; over all cores when the work on each text is ``costly``."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("book_id"), (F.col("doc_id") % 50).alias("user_id"),
        F.col("text").alias("review_text"), F.col("n_chars").alias("n_votes"), "source")
    return spread(documents) if costly else documents


def rated(reviews: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with the label of their document as ``rating``; take only the columns needed there."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("book_id"), F.col("quality").alias("rating"))
    return reviews.join(labels, "book_id", "left")
