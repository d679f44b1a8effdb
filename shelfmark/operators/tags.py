"""Operators over nested tags and the item graph held in arrays."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import GENERIC_SHELVES


def flatten_tags(df: DataFrame, key: str = "book_id", array: str = "popular_shelves",
                 carry: Sequence[str] = ()) -> DataFrame:
    """One row per (record, tag): key, carried columns, shelf_name, shelf_count."""
    return (df.select(key, *carry, F.explode(array).alias("_tag"))
              .select(key, *carry, F.col("_tag.name").alias("shelf_name"),
                      F.col("_tag.count").try_cast("int").alias("shelf_count")))


def tag_popularity(df: DataFrame, key: str = "book_id", array: str = "popular_shelves") -> DataFrame:
    """Per tag, the records carrying it and its total use; unsorted.

    A tag that is on nearly every record is no hot spot: counts are combined
    within each task, and the shuffle moves one row per task and tag.
    """
    return (flatten_tags(df, key, array)
            .groupBy("shelf_name")
            .agg(F.count(key).alias("books_with_shelf"),
                 F.sum("shelf_count").alias("total_shelf_count")))


def by_popularity(popularity: DataFrame) -> DataFrame:
    return popularity.orderBy(F.desc("books_with_shelf"), "shelf_name")


def by_usage(popularity: DataFrame) -> DataFrame:
    return popularity.orderBy(F.desc("total_shelf_count"), "shelf_name")


def reference_counts(df: DataFrame, key: str = "book_id", array: str = "similar_books") -> DataFrame:
    """In-degree of every item that is linked to; unsorted."""
    return (df.select(key, F.explode(array).alias("similar_book_id"))
              .groupBy("similar_book_id")
              .agg(F.count(key).alias("referenced_count")))


def most_referenced(df: DataFrame, k: int = 50, key: str = "book_id",
                    array: str = "similar_books") -> DataFrame:
    return (reference_counts(df, key, array)
            .orderBy(F.desc("referenced_count"), "similar_book_id")
            .limit(k))


def top_topics(df: DataFrame, k: int = 3, key: str = "book_id", title: str = "title",
               array: str = "popular_shelves", exclude: Sequence[str] = GENERIC_SHELVES) -> DataFrame:
    """The ``k`` most used tags of each record that are not generic, as an array.

    A record's tags lie in its own row, so they are ranked there: no explode and
    no shuffle. Ties go by name; a tag without a usable count ranks last; a
    record with generic tags only has no row. Needs one row per key, which is
    what ``key_uniqueness`` verifies; ``top_topics_of_rows`` does without.
    """
    generic = F.array(*[F.lit(v) for v in exclude]).cast("array<string>")

    def usable(s: Column) -> Column:
        return s["name"].isNotNull() & ~F.array_contains(generic, s["name"])

    ranked = F.array_sort(F.transform(F.filter(array, usable), lambda s: F.struct(
        s["count"].try_cast("int").isNull().alias("unknown"),
        (-s["count"].try_cast("long")).alias("order"),
        s["name"].alias("name"))))
    return (df.filter(F.exists(array, usable))
              .select(key, title, F.transform(F.slice(ranked, 1, k), lambda s: s["name"]).alias("topics")))


def top_topics_of_rows(tags: DataFrame, k: int = 3, key: str = "book_id", title: str = "title",
                       exclude: Sequence[str] = GENERIC_SHELVES) -> DataFrame:
    """The same from (key, title, shelf_name, shelf_count) rows, as ``flatten_tags`` makes them.

    ``row_number() <= k`` lets each task discard all but ``k`` rows per key before
    the shuffle, so a key with very many rows stays small; the arrays hold at
    most ``k`` names.
    """
    ranking = Window.partitionBy(key).orderBy(F.col("shelf_count").desc_nulls_last(), "shelf_name")
    ranked = (tags.filter(F.col("shelf_name").isNotNull() & ~F.col("shelf_name").isin(list(exclude)))
                  .withColumn("_rank", F.row_number().over(ranking))
                  .filter(F.col("_rank") <= k))
    collected = F.sort_array(F.collect_list(F.struct("_rank", "shelf_name")))
    return ranked.groupBy(key, title).agg(F.transform(collected, lambda s: s["shelf_name"]).alias("topics"))
