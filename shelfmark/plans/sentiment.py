"""Sentiment of the review texts and insight per book."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import reports as rp, sentiment as sn
from ..schemas import LEXICON
from ..sources import files

TOP_BOOKS = 1_000
SAMPLE_REVIEWS = 20_000


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A (word, polarity) table as CSV with a header."""
    return spark.read.schema(LEXICON).option("header", True).csv(path)


def run(spark: SparkSession, source: str, lexicon: DataFrame, out: str,
        min_reviews: int = 20) -> dict[str, DataFrame]:
    """Write scored reviews, insights and their JSON exports; returns the chart tables.

    The scored reviews are written first and read back, so the texts are scored
    once although four results use the scores.
    """
    reviews = files.spread(files.read_parquet(spark, source))
    scored = sn.score_reviews(reviews, lexicon)
    files.write_parquet(scored, f"{out}/scored/parquet")
    scored = files.read_parquet(spark, f"{out}/scored/parquet")

    files.write_parquet(sn.by_sentiment(sn.group_insights(scored, min_count=min_reviews)),
                        f"{out}/insights/parquet")
    insights = files.read_parquet(spark, f"{out}/insights/parquet")
    best_first = (F.desc("avg_sentiment"), "book_id", "title")
    files.export_sample(insights, TOP_BOOKS, f"{out}/insights/json_top_books", order_by=best_first)
    files.export_sample(scored.select("title", "sentiment_label", "sentiment_score", "book_id", "user_id"),
                        SAMPLE_REVIEWS, f"{out}/scored/json_reviews", key=["book_id", "user_id"])
    return {"sentiment_distribution": rp.label_counts(scored, "sentiment_label"),
            "top_books": sn.by_sentiment(insights, 10)}
