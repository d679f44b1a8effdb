"""The standard reports over a catalogue, as instances of the generic ones.

Column names are parameters with the usual names as defaults.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import ladders
from ..functions.text import KEYWORDS, keyword_total
from . import reports as rp
from .filters import has_items_sql, has_text_sql
from .reports import name

# ---- fixed values: labels of the splits into two; the titles below are fixed as well ----
SERIES_SPLIT = ("Books in Series", "Standalone Books")
SHELVES_SPLIT = ("Books with Shelves", "Books without Shelves")
SIMILAR_SPLIT = ("Books with Similar Books", "Books without Similar Books")


def missing_values() -> rp.Report:
    return rp.missing("missing", text=["description"], arrays=["authors", "popular_shelves"],
                      plain=["average_rating"])


def _positive(column: str) -> str:
    return f"CASE WHEN {name(column)} > 0 THEN {name(column)} END"


def page_summary(column: str = "num_pages") -> rp.Report:
    return rp.summary("page_stats", _positive(column), "pages")


def page_distribution(column: str = "num_pages", ladder=ladders.PAGES) -> rp.Report:
    return rp.histogram("page_distribution", _positive(column), ladder, "page_category")


def series_split(column: str = "series") -> rp.Report:
    return rp.presence("series_split", has_items_sql(name(column)), *SERIES_SPLIT)


def series_distribution(column: str = "series", ladder=ladders.SERIES) -> rp.Report:
    return rp.histogram("series_count_distribution", f"size({name(column)})", ladder, "series_category",
                        share_of_all=True)


def rating_summary(column: str = "average_rating") -> rp.Report:
    return rp.moments("rating_stats", name(column), "rating")


def rating_distribution(column: str = "average_rating", ladder=ladders.RATING) -> rp.Report:
    return rp.histogram("rating_distribution", name(column), ladder, "rating_bucket")


def engagement_summary(column: str = "ratings_count") -> rp.Report:
    return rp.summary("engagement_stats", name(column), "ratings")


def engagement_distribution(column: str = "ratings_count", ladder=ladders.ENGAGEMENT) -> rp.Report:
    return rp.histogram("engagement_distribution", name(column), ladder, "engagement_level")


def quality_vs_engagement(rating: str = "average_rating", count: str = "ratings_count",
                          quality=ladders.QUALITY, reach=ladders.REACH) -> rp.Report:
    return rp.crosstab("quality_vs_engagement", name(rating), quality, "rating_quality",
                       name(count), reach, "engagement_level")


def quality_matrix(rating: str = "average_rating", count: str = "ratings_count",
                   quality=ladders.QUALITY, reach=ladders.REACH) -> rp.Report:
    return rp.crosstab_matrix("quality_matrix", name(rating), quality, "rating_quality", name(count), reach)


def shelves_split(column: str = "popular_shelves") -> rp.Report:
    return rp.presence("shelves_split", has_items_sql(name(column)), *SHELVES_SPLIT)


def shelves_distribution(column: str = "popular_shelves", ladder=ladders.SHELVES) -> rp.Report:
    return rp.histogram("shelves_count_distribution", f"size({name(column)})", ladder, "shelves_category",
                        share_of_all=True)


def average_shelves(column: str = "popular_shelves") -> rp.Report:
    return rp.average_size("avg_shelves", column, "avg_shelves_per_book")


def similar_split(column: str = "similar_books") -> rp.Report:
    return rp.presence("similar_split", has_items_sql(name(column)),
                       *SIMILAR_SPLIT)


def similar_distribution(column: str = "similar_books", ladder=ladders.SIMILAR) -> rp.Report:
    return rp.histogram("similar_books_distribution", f"size({name(column)})", ladder, "similar_category",
                        share_of_all=True)


def average_similar(column: str = "similar_books") -> rp.Report:
    return rp.average_size("avg_similar", column, "avg_similar_books")


def similar_vs_performance(similar: str = "similar_books", rating: str = "average_rating",
                           count: str = "ratings_count", ladder=ladders.SIMILAR_WIDE) -> rp.Report:
    return rp.profile("similar_vs_performance", f"size({name(similar)})", ladder, "similar_category",
                      {"avg_rating": name(rating), "avg_engagement": name(count),
                       "avg_similar_count": f"size({name(similar)})"})


def similar_trend(performance: DataFrame) -> DataFrame:
    """The trend of the average rating over the rows of ``similar_vs_performance``."""
    return rp.linear_trend(performance, "avg_similar_count", "avg_rating")


def _keyword_total(text: str, keywords: Sequence[str], match: str) -> tuple[dict, tuple]:
    """The lower-cased text as input, and as a layer on it the number of keywords found."""
    return ({"text": f"CASE WHEN {has_text_sql(name(text))} THEN lower({name(text)}) END"},
            (lambda m: {"value": keyword_total(m("text"), keywords, match)},))


def keyword_density(text: str = "description", keywords: Sequence[str] = KEYWORDS,
                    match: str = "substring", ladder=ladders.KEYWORD_DENSITY) -> rp.Report:
    inputs, layers = _keyword_total(text, keywords, match)
    return rp.histogram_of("keyword_count_distribution", inputs, layers, ladder, "keyword_category")


def average_keywords(text: str = "description", keywords: Sequence[str] = KEYWORDS,
                     match: str = "substring") -> rp.Report:
    inputs, layers = _keyword_total(text, keywords, match)
    return rp.average_of("avg_keywords", inputs, layers, "avg_keywords_per_book")
