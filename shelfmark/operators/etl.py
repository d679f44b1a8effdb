"""From raw catalogue and review records to the three curated datasets."""

from pyspark.sql import Column, DataFrame, functions as F

from .joins import skew_join


def normalize_books(raw: DataFrame) -> DataFrame:
    """The eleven catalogue columns; a number that does not parse becomes NULL."""
    def number(column: str, kind: str) -> Column:
        return F.col(column).try_cast(kind).alias(column)

    return raw.select(
        "book_id", "title", "authors", "description",
        number("average_rating", "double"),
        *[number(c, "int") for c in ("num_pages", "ratings_count", "text_reviews_count")],
        "popular_shelves", "series", "similar_books")


def normalize_reviews(raw: DataFrame) -> DataFrame:
    """The six review columns; a number that does not parse becomes NULL."""
    return raw.select(
        "book_id", "user_id", "review_text",
        *[F.col(c).try_cast("int").alias(c) for c in ("rating", "n_votes")],
        "date_added")


def reviews_with_books(reviews: DataFrame, books: DataFrame, key: str = "book_id",
                       hot: dict | None = None) -> DataFrame:
    """Each review with its book; reviews of unknown books are left out."""
    return skew_join(reviews, books, key, hot=hot)


def with_text(reviews: DataFrame, min_len: int = 10, text: str = "review_text") -> DataFrame:
    """Reviews with more than ``min_len`` characters of text."""
    return reviews.filter(F.length(text) > min_len)


def with_rating(reviews: DataFrame, rating: str = "rating") -> DataFrame:
    """Reviews that carry a rating (0 stands for none)."""
    return reviews.filter(F.col(rating) > 0)


def nlp_subset(full: DataFrame, min_len: int = 10, text: str = "review_text") -> DataFrame:
    """Review columns of the reviews ``with_text``; filter them before they join the books as well."""
    return with_text(full, min_len, text).select("book_id", "user_id", text, "rating", "n_votes", "title")


def rec_subset(full: DataFrame, rating: str = "rating") -> DataFrame:
    """Rating and book columns of the reviews ``with_rating``; filter them before they join the books as well."""
    return with_rating(full, rating).select("user_id", "book_id", rating, "title", "popular_shelves", "series",
                                            "similar_books", "description", "average_rating")


def eda_subset(books: DataFrame, min_ratings: int = 10) -> DataFrame:
    """Books with more than ``min_ratings`` ratings and a page count."""
    return books.filter((F.col("ratings_count") > min_ratings) & (F.col("num_pages") > 0))
