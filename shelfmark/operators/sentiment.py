"""Lexicon sentiment of reviews: score, label, and insight per item.

The score of a text is the mean polarity of its words that are in the lexicon,
0.0 when there are none. The lexicon is a table (word, polarity in [-1, 1]).
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import alnum_only, words
from .joins import fits_a_broadcast, hot_keys, skew_join

# Polarities are added up as whole numbers of this unit, so their order changes no score.
UNITS = 1_000_000_000
# Of the texts, how many are looked at for words that are met very often.
SAMPLED_TEXTS = 0.02

# ---- fixed values: label thresholds ----
POSITIVE_FROM = 0.1
NEGATIVE_UP_TO = -0.1


def _units_per_word(lexicon: DataFrame) -> DataFrame:
    """(word, units): words in small letters, repeated ones with the mean of their polarities."""
    return (lexicon.filter(F.col("word").isNotNull() & F.col("polarity").isNotNull())
                   .groupBy(F.lower("word").alias("word"))
                   .agg(F.round(F.avg("polarity") * UNITS).cast("long").alias("units")))


def sentiment_score(df: DataFrame, text: str, lexicon: DataFrame, replacement: str = "",
                    score: str = "sentiment_score", strategy: str | None = None) -> DataFrame:
    """``df`` with the sentiment of ``text`` in a new column.

    Words are joined to the lexicon, which Spark broadcasts if it is small; then no word
    leaves its task before the sums per text. ``strategy`` is a join hint for the lexicon.
    The score depends on the text alone, so its digest is the key: copies of a text fall
    together, and a much copied one is salted when the scores go back to the rows. Of
    these only the columns that the caller goes on to use are moved. Polarities are exact
    in units of 1e-9 and divided once.
    """
    units = _units_per_word(lexicon)
    cleaned = words(alnum_only(F.col(text), replacement))
    digest = F.sha2(F.col(text), 256).alias("_digest")
    small = strategy is None and fits_a_broadcast(units)
    common = {} if small else hot_keys(
        df.sample(fraction=SAMPLED_TEXTS, seed=17).select(F.explode(cleaned).alias("word")), "word", sample=1.0)
    # The digest first: beside the explode it would be worked out again for every word. The
    # outer explode, because for the other Spark splits every text once more to see whether it is empty.
    tokens = df.select(digest, cleaned.alias("_words")).select("_digest", F.explode_outer("_words").alias("word"))
    found = skew_join(tokens, units.hint(strategy) if strategy else units, "word", hot=common)
    # Copies are counted alike, so a text's sum over all of them has the same mean.
    scores = found.groupBy("_digest").agg(
        (F.sum("units").cast("double") / (F.count(F.lit(1)) * F.lit(float(UNITS)))).alias(score))
    copied = hot_keys(df.select(digest), "_digest")
    return (skew_join(df.select("*", digest), scores, "_digest", "left", hot=copied)
            .select(*df.columns, F.coalesce(score, F.lit(0.0)).alias(score)))


def sentiment_label(score: str | Column = "sentiment_score") -> Column:
    value = F.col(score) if isinstance(score, str) else score
    return (F.when(value >= POSITIVE_FROM, "POSITIVE")
             .when(value <= NEGATIVE_UP_TO, "NEGATIVE")
             .otherwise("NEUTRAL"))


def score_reviews(reviews: DataFrame, lexicon: DataFrame, text: str = "review_text",
                  replacement: str = "", strategy: str | None = None) -> DataFrame:
    """Reviews with sentiment_score and sentiment_label."""
    scored = sentiment_score(reviews, text, lexicon, replacement, strategy=strategy)
    return scored.withColumn("sentiment_label", sentiment_label())


def group_insights(scored: DataFrame, keys: Sequence[str] = ("book_id", "title"), min_count: int = 20,
                   score: str = "sentiment_score", rating: str = "rating") -> DataFrame:
    """Average sentiment against average rating of the items with more than ``min_count`` reviews."""
    return (scored.groupBy(*keys)
                  .agg(F.avg(score).alias("avg_sentiment"),
                       F.avg(rating).alias("avg_rating"),
                       F.count(score).alias("review_count"))
                  .filter(F.col("review_count") > min_count))


def by_sentiment(insights: DataFrame, k: int | None = None,
                 keys: Sequence[str] = ("book_id", "title")) -> DataFrame:
    """Best first; the first ``k`` when given."""
    ranked = insights.orderBy(F.desc("avg_sentiment"), *keys)
    return ranked if k is None else ranked.limit(k)
