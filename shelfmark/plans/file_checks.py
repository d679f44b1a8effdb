"""Queries with SQL twins for normalisation, files, samples, bulk requests, standard bounds and declared order."""

from uuid import uuid4

from pyspark.sql import DataFrame, Window, functions as F

from ..checkpoints import checkpoint_dir, pin_partitions
from ..functions.text import KEYWORDS
from ..operators import catalogue as cat, etl, keywords as kw, reports as rp
from ..schemas import RAW_BOOKS, RAW_REVIEWS
from ..sources import files, tables as tb
from .checks import BOOKS, RATED, _case, _histogram, _pct, query

# ----------------------------------------------------------- dirty records

# Numbers as raw records have them: missing, empty, not a number, out of range, or right.
DIRTY = """CASE {n} % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'n/a' WHEN 3 THEN '99999999999'
  WHEN 4 THEN concat('-', {v}) ELSE concat({v}, '') END"""
RATING_TEXT = "CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN 'four' WHEN 2 THEN NULL ELSE concat(p_size % 5, '.', p_size % 10) END"


def raw_books(spark, sf) -> DataFrame:
    return tb.table(spark, sf, "part").selectExpr(
        "string(p_partkey) AS book_id", "p_name AS title", "array(struct(p_brand AS author_id, 'Author' AS role)) AS authors",
        "p_type AS description", f"{RATING_TEXT} AS average_rating",
        f"{DIRTY.format(n='p_size', v='p_size * 20')} AS num_pages",
        f"{DIRTY.format(n='p_partkey', v='p_size')} AS ratings_count",
        f"{DIRTY.format(n='(p_partkey + 3)', v='p_partkey')} AS text_reviews_count",
        "array(struct(string(p_size) AS count, p_brand AS name)) AS popular_shelves",
        "array_repeat(p_brand, p_size % 3) AS series", "array(string(p_partkey + 1)) AS similar_books")


BOOKS_SQL = f"""SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title,
  TRY_CAST({RATING_TEXT} AS DOUBLE) AS average_rating,
  TRY_CAST({DIRTY.format(n="p_size", v="p_size * 20")} AS INTEGER) AS num_pages,
  TRY_CAST({DIRTY.format(n="p_partkey", v="p_size")} AS INTEGER) AS ratings_count,
  TRY_CAST({DIRTY.format(n="(p_partkey + 3)", v="p_partkey")} AS INTEGER) AS text_reviews_count,
  CAST(p_size AS VARCHAR) || ':' || p_brand AS shelf, p_size % 3 AS n_series FROM part"""


def _flat(books: DataFrame) -> DataFrame:
    return books.selectExpr("book_id", "title", "average_rating", "num_pages", "ratings_count", "text_reviews_count",
                            "concat(popular_shelves[0].count, ':', popular_shelves[0].name) AS shelf",
                            "size(series) AS n_series")


@query(BOOKS_SQL)
def normalized_books(spark, sf):
    return _flat(etl.normalize_books(raw_books(spark, sf)))


def raw_reviews(spark, sf) -> DataFrame:
    return tb.table(spark, sf, "lineitem").selectExpr(
        "string(l_partkey) AS book_id", "string(l_orderkey) AS user_id", "l_returnflag AS review_text",
        f"{DIRTY.format(n='l_linenumber', v='l_linenumber')} AS rating",
        f"{DIRTY.format(n='l_partkey', v='l_linenumber')} AS n_votes", "l_linestatus AS date_added")


REVIEWS_SQL = f"""SELECT CAST(l_partkey AS VARCHAR) AS book_id, CAST(l_orderkey AS VARCHAR) AS user_id,
  l_returnflag AS review_text, TRY_CAST({DIRTY.format(n="l_linenumber", v="l_linenumber")} AS INTEGER) AS rating,
  TRY_CAST({DIRTY.format(n="l_partkey", v="l_linenumber")} AS INTEGER) AS n_votes, l_linestatus AS date_added FROM lineitem"""


@query(REVIEWS_SQL)
def normalized_reviews(spark, sf):
    return etl.normalize_reviews(raw_reviews(spark, sf))


# -------------------------------------------------------------------- files

def _place(spark) -> str:
    return f"{checkpoint_dir(spark)}/written-{uuid4().hex}"


@query(BOOKS_SQL)
def json_round_trip(spark, sf):
    """Raw records written as JSON lines, read by a glob with the declared schema, and normalised."""
    place = _place(spark)
    files.write_json(raw_books(spark, sf), f"{place}/raw_books.json")
    return _flat(etl.normalize_books(files.read_json(spark, f"{place}/*books*.json", RAW_BOOKS)))


@query(REVIEWS_SQL)
def parquet_round_trip(spark, sf):
    place = _place(spark)
    files.write_parquet(etl.normalize_reviews(raw_reviews(spark, sf)), place)
    return files.read_parquet(spark, place)


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def csv_round_trip(spark, sf):
    place = _place(spark)
    nations = tb.table(spark, sf, "nation").join(tb.table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    files.write_csv(nations.select("n_nationkey", "n_name", "r_name"), place)
    return spark.read.schema("n_nationkey int, n_name string, r_name string").option("header", True).csv(place)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey * 37 % 1009, p_partkey LIMIT 100")
def sampled_rows(spark, sf):
    parts = tb.table(spark, sf, "part").select("p_partkey", "p_name")
    return files.sample_rows(parts, 100, ["p_partkey"], place=F.expr("p_partkey * 37 % 1009"))


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 50")
def json_sample(spark, sf):
    """The bounded sample in one file, read back."""
    place = _place(spark)
    files.export_sample(tb.table(spark, sf, "part").select("p_partkey", "p_size"), 50, place,
                        order_by=[F.desc("p_size"), "p_partkey"])
    return files.read_json(spark, place, spark.createDataFrame([], "p_partkey long, p_size int").schema)


@query("SELECT count(*) AS documents, count(DISTINCT p_partkey) AS ids, 0 AS oversize FROM part")
def bulk_batches(spark, sf):
    """Every document in exactly one request body of at most 500."""
    lines = files.bulk_index_lines(tb.catalogue(spark, sf), "catalogue", doc_cols=["title"])
    batches = files.bulk_batches(lines)
    ids = batches.select(F.explode(F.regexp_extract_all("value", F.lit('"_id":"?([0-9]+)'), F.lit(1))).alias("id"))
    sizes = batches.agg(F.sum("documents").alias("documents"), F.count_if(F.col("documents") > 500).cast("int").alias("oversize"))
    return sizes.withColumn("one", F.lit(1)).join(
        ids.agg(F.count_distinct("id").alias("ids")).withColumn("one", F.lit(1)), "one").drop("one")


# ------------------------------------------------------- standard bounds, order

SCALED = f"""{RATED}, scaled AS (SELECT *, average_rating * 1.4::DOUBLE AS rating, ratings_count * ratings_count * 20 AS reach
  FROM rated)"""


def _scaled(spark, sf) -> DataFrame:
    """Ratings and counts of the size that the standard bounds are made for."""
    return tb.rated_catalogue(spark, sf).selectExpr("average_rating * 1.4D AS average_rating",
                                                    "ratings_count * ratings_count * 20 AS ratings_count")


@query(_histogram(SCALED, "scaled", "reach", cat.ladders.ENGAGEMENT, "engagement_level", "reach"))
def engagement_standard(spark, sf):
    return cat.engagement_distribution().of(_scaled(spark, sf))


@query(f"""WITH {SCALED} SELECT {_case("rating", cat.ladders.QUALITY)} AS rating_quality,
  {_case("reach", cat.ladders.REACH)} AS engagement_level, count(*) AS book_count
  FROM scaled WHERE rating IS NOT NULL AND reach IS NOT NULL GROUP BY 1, 2""")
def quality_vs_engagement_standard(spark, sf):
    return cat.quality_vs_engagement().of(_scaled(spark, sf))


HAS = {k: f"CASE WHEN contains(lower(text), '{k}') THEN 1 ELSE 0 END" for k in KEYWORDS}


@query("WITH d AS (SELECT * FROM documents WHERE text <> '') " + " UNION ALL ".join(
    f"""SELECT '{k}' AS keyword, count(*) FILTER (WHERE {h} = 1) AS book_count,
    {_pct(f"count(*) FILTER (WHERE {h} = 1)", "count(*)")} AS percentage FROM d""" for k, h in HAS.items()))
def keyword_frequency_standard(spark, sf):
    return kw.keyword_frequency(tb.texts(spark, sf))


@query("SELECT doc_id AS book_id, " + ", ".join(f'{h} AS "has_{k}"' for k, h in HAS.items())
       + f", {' + '.join(HAS.values())} AS total_keywords FROM documents WHERE text <> ''")
def keyword_flags_standard(spark, sf):
    return kw.keyword_flags(tb.texts(spark, sf))


def _numbered(frame: DataFrame) -> DataFrame:
    """The rows of a small report with their place in it."""
    return frame.coalesce(1).withColumn("position", F.monotonically_increasing_id())


def _numbered_by_part(ordered: DataFrame) -> DataFrame:
    """All rows of an ordered frame with their place in it: each partition numbers its own, only its count moves."""
    rows = pin_partitions(ordered).select("*", F.spark_partition_id().alias("_part"),
                                          F.monotonically_increasing_id().alias("_id"))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(starts), "_part").withColumn("position", F.col("_id") + F.col("_shift")).drop(
        "_part", "_id", "_shift")


@query(f"""WITH {BOOKS} SELECT row_number() OVER (ORDER BY min(num_pages)) - 1 AS position,
  {_case("num_pages", cat.ladders.PAGES)} AS page_category, count(*) AS book_count
  FROM books WHERE num_pages > 0 GROUP BY 2""".replace("GROUP BY 2", "GROUP BY page_category"))
def page_distribution_in_order(spark, sf):
    return _numbered(cat.page_distribution().of(tb.catalogue(spark, sf)).select("page_category", "book_count"))


@query("SELECT row_number() OVER (ORDER BY source) - 1 AS position, source, count(*) AS n FROM documents GROUP BY source")
def label_counts_in_order(spark, sf):
    counts = rp.label_counts(tb.table(spark, sf, "documents"), "source", "n")
    return _numbered_by_part(counts.orderBy(F.asc_nulls_last("source")))
