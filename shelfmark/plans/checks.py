"""Every operator as a named query over the star-schema tables, with its SQL twin.

A query without SQL is one whose result SQL cannot state (model fits).
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..checkpoints import materialise
from ..functions.ladders import Ladder
from ..functions.numbers import rounded
from ..functions.text import alnum_only, letters_only
from ..operators import (catalogue as cat, clustering, etl, filters, keywords as kw, ratings as rt,
                         recommend as rec, reports as rp, sentiment as sn, tags)
from ..schemas import LEXICON
from ..sources import files, tables as tb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function
    return register


# ------------------------------------------------------------- SQL fragments

def _round(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return _round(f"100.0::DOUBLE * ({part}) / nullif({whole}, 0)")


BOOKS = """books AS (
  SELECT p_partkey AS book_id, p_name AS title, p_brand || ' ' || p_type AS description,
         (p_size - 1) * 20 AS num_pages, p_brand,
         CASE WHEN p_type <> 'PROMO' THEN p_size % 6 END AS n_series,
         CASE WHEN p_type <> 'SMALL' THEN CASE WHEN p_size > 1
              THEN list_concat([p_partkey - p_partkey % 100], range(p_partkey + 1, p_partkey + p_size))
              ELSE [] END END AS similar_books
  FROM part)"""

GIVEN = "CASE WHEN floor(l_quantity / 10) > 0 THEN CAST(floor(l_quantity / 10) AS INTEGER) END"

RATED = BOOKS + f""", stats AS (
  SELECT l_partkey, avg({GIVEN}) AS average_rating, CAST(count({GIVEN}) AS INTEGER) AS ratings_count,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS text_reviews_count
  FROM lineitem GROUP BY l_partkey),
rated AS (
  SELECT b.*, average_rating, ratings_count, text_reviews_count, len(similar_books) AS n_similar
  FROM books b LEFT JOIN stats ON book_id = l_partkey)"""

SHELF_ROWS = """shelf_rows AS (
  SELECT l_partkey AS book_id, lower(n_name) AS shelf_name, count(*) AS shelf_count
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_partkey, lower(n_name))"""

SHELVED = BOOKS + ", " + SHELF_ROWS + """, sizes AS (
  SELECT book_id AS b, count(*) AS n_shelves FROM shelf_rows GROUP BY book_id),
shelved AS (SELECT books.*, n_shelves FROM books LEFT JOIN sizes ON book_id = b)"""

RATINGS = """ratings AS (
  SELECT l_partkey AS book_id, o_custkey AS user_id, CAST(floor(l_quantity / 10) AS INTEGER) AS rating,
         l_linenumber AS n_votes, strftime(o_orderdate, '%Y-%m-%d') AS date_added
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DEDUPED = RATINGS + """, deduped AS (
  SELECT user_id, book_id, avg(rating) AS rating, max(p_name) AS title
  FROM ratings JOIN part ON book_id = p_partkey WHERE rating > 0 GROUP BY user_id, book_id)"""


def _case(value: str, ladder: Ladder, results: list[str] | None = None) -> str:
    op = "<=" if ladder.inclusive else "<"
    results = results or [f"'{label}'" for label in ladder.labels]
    steps = " ".join(f"WHEN {value} {op} {bound} THEN {out}" for (bound, _), out in zip(ladder.steps, results))
    return f"CASE {steps} ELSE {results[-1]} END"


def _histogram(with_: str, source: str, value: str, ladder: Ladder, label: str, whole: str) -> str:
    return f"""WITH {with_}
SELECT {_case(value, ladder)} AS {label}, count(*) AS book_count,
       {_pct("count(*)", f"(SELECT count({whole}) FROM {source})")} AS percentage
FROM {source} WHERE {value} IS NOT NULL GROUP BY 1"""


def _split(with_: str, source: str, present: str, yes: str, no: str) -> str:
    return f"""WITH {with_}, counted AS (
  SELECT count(*) FILTER (WHERE {present}) AS yes, count(*) AS total FROM {source})
SELECT '{yes}' AS "group", yes AS book_count, {_pct("yes", "total")} AS percentage FROM counted
UNION ALL
SELECT '{no}', total - yes, {_pct("total - yes", "total")} FROM counted"""


# Line items give a part about 25 ratings, so these reports use bounds of that order.
ENGAGEMENT = Ladder(((16, "<16"), (20, "16-20"), (24, "20-24"), (28, "24-28")), "28+")
QUALITY = Ladder(((2.4, "Low"), (2.7, "Medium")), "High")
REACH = Ladder(((20, "Rare"), (26, "Known")), "Popular")


# ------------------------------------------------------ counts and summaries

@query("""SELECT count(*) AS total_rows, count(DISTINCT p_partkey) AS distinct_keys FROM part""")
def dataset_counts(spark, sf):
    return rp.key_uniqueness(tb.table(spark, sf, "part"), "p_partkey")


@query("WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {p}) AS missing,
        {_pct(f"count(*) FILTER (WHERE {p})", "count(*)")} AS percentage FROM d"""
    for c, p in (("text", "text IS NULL OR text = ''"), ("source", "source IS NULL OR source = ''"),
                 ("quality", "quality IS NULL"), ("toxic", "toxic IS NULL"))))
def missing_profile(spark, sf):
    labelled = tb.table(spark, sf, "documents").join(tb.table(spark, sf, "labels"), "doc_id", "left")
    return rp.missing("missing", text=["text", "source"], plain=["quality", "toxic"]).of(labelled)


@query(f"WITH {RATED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {p}) AS missing,
        {_pct(f"count(*) FILTER (WHERE {p})", "count(*)")} AS percentage FROM rated"""
    for c, p in (("description", "description IS NULL OR description = ''"),
                 ("series", "n_series IS NULL OR n_series = 0"),
                 ("similar_books", "n_similar IS NULL OR n_similar = 0"),
                 ("average_rating", "average_rating IS NULL"))))
def missing_in_catalogue(spark, sf):
    report = rp.missing("missing", text=["description"], arrays=["series", "similar_books"],
                        plain=["average_rating"])
    return report.of(tb.rated_catalogue(spark, sf))


def _summary_sql(with_: str, source: str, value: str, suffix: str, where: str) -> str:
    mean, median = f"avg({value})", f"quantile_disc({value}, 0.5)"
    return f"""WITH {with_} SELECT {_round(mean)} AS mean_{suffix}, {_round(f"stddev_samp({value})")} AS std_{suffix},
  min({value}) AS min_{suffix}, max({value}) AS max_{suffix}, quantile_disc({value}, 0.25) AS q1_{suffix},
  {median} AS median_{suffix}, quantile_disc({value}, 0.75) AS q3_{suffix},
  {_round(f"{_round(mean)} - {median}")} AS mean_median_gap FROM {source} WHERE {where}"""


@query(_summary_sql(BOOKS, "books", "num_pages", "pages", "num_pages > 0"))
def page_summary(spark, sf):
    return cat.page_summary().of(tb.catalogue(spark, sf))


@query(_summary_sql(RATED, "rated", "ratings_count", "ratings", "ratings_count IS NOT NULL"))
def engagement_summary(spark, sf):
    return cat.engagement_summary().of(tb.rated_catalogue(spark, sf))


@query(f"""WITH {RATED} SELECT {_round("avg(average_rating)")} AS mean_rating,
  {_round("stddev_samp(average_rating)")} AS std_rating, min(average_rating) AS min_rating,
  max(average_rating) AS max_rating FROM rated""")
def rating_summary(spark, sf):
    return cat.rating_summary().of(tb.rated_catalogue(spark, sf))


@query(f"""WITH {BOOKS} """ + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS quantile, quantile_disc(num_pages, {p}) AS value FROM books"
    for p in (0.1, 0.5, 0.9)))
def approx_quantiles(spark, sf):
    return rp.quantile_report("q", "num_pages", (0.1, 0.5, 0.9)).of(tb.catalogue(spark, sf))


# ------------------------------------------------------------- distributions

@query(_histogram(BOOKS + ", paged AS (SELECT * FROM books WHERE num_pages > 0)", "paged", "num_pages",
                  cat.ladders.PAGES, "page_category", "*"))
def page_distribution(spark, sf):
    return cat.page_distribution().of(tb.catalogue(spark, sf))


@query(_histogram(BOOKS, "books", "n_series", cat.ladders.SERIES, "series_category", "*"))
def series_distribution(spark, sf):
    return cat.series_distribution().of(tb.catalogue(spark, sf))


@query(_split(BOOKS, "books", "n_series > 0", "Books in Series", "Standalone Books"))
def series_split(spark, sf):
    return cat.series_split().of(tb.catalogue(spark, sf))


@query(_histogram(RATED, "rated", "average_rating", cat.ladders.RATING, "rating_bucket", "average_rating"))
def rating_distribution(spark, sf):
    return cat.rating_distribution().of(tb.rated_catalogue(spark, sf))


@query(_histogram(RATED, "rated", "ratings_count", ENGAGEMENT, "engagement_level", "ratings_count"))
def engagement_distribution(spark, sf):
    return cat.engagement_distribution(ladder=ENGAGEMENT).of(tb.rated_catalogue(spark, sf))


@query(f"""WITH {RATED} SELECT {_case("average_rating", QUALITY)} AS rating_quality,
  {_case("ratings_count", REACH)} AS engagement_level, count(*) AS book_count
  FROM rated WHERE average_rating IS NOT NULL AND ratings_count IS NOT NULL GROUP BY 1, 2""")
def quality_vs_engagement(spark, sf):
    return cat.quality_vs_engagement(quality=QUALITY, reach=REACH).of(tb.rated_catalogue(spark, sf))


@query(f"""WITH {RATED}, cells AS (
  SELECT {_case("average_rating", QUALITY)} AS q, {_case("ratings_count", REACH)} AS e
  FROM rated WHERE average_rating IS NOT NULL AND ratings_count IS NOT NULL)
SELECT v AS rating_quality, count(q) FILTER (WHERE e = 'Rare') AS "Rare",
       count(q) FILTER (WHERE e = 'Known') AS "Known", count(q) FILTER (WHERE e = 'Popular') AS "Popular"
FROM (VALUES ('Low'), ('Medium'), ('High')) r(v) LEFT JOIN cells ON q = v GROUP BY v""")
def quality_matrix(spark, sf):
    return cat.quality_matrix(quality=QUALITY, reach=REACH).of(tb.rated_catalogue(spark, sf))


@query(_histogram(SHELVED, "shelved", "n_shelves", cat.ladders.SHELVES, "shelves_category", "*"))
def shelves_distribution(spark, sf):
    return cat.shelves_distribution().of(tb.shelved_catalogue(spark, sf))


@query(_split(SHELVED, "shelved", "n_shelves > 0", "Books with Shelves", "Books without Shelves"))
def shelves_split(spark, sf):
    return cat.shelves_split().of(tb.shelved_catalogue(spark, sf))


@query(f"WITH {SHELVED} SELECT {_round('avg(n_shelves)')} AS avg_shelves_per_book FROM shelved WHERE n_shelves > 0")
def average_shelves(spark, sf):
    return cat.average_shelves().of(tb.shelved_catalogue(spark, sf))


@query(_histogram(RATED, "rated", "n_similar", cat.ladders.SIMILAR, "similar_category", "*"))
def similar_distribution(spark, sf):
    return cat.similar_distribution().of(tb.catalogue(spark, sf))


@query(_split(RATED, "rated", "n_similar > 0", "Books with Similar Books", "Books without Similar Books"))
def similar_split(spark, sf):
    return cat.similar_split().of(tb.catalogue(spark, sf))


@query(f"WITH {RATED} SELECT {_round('avg(n_similar)')} AS avg_similar_books FROM rated WHERE n_similar > 0")
def average_similar(spark, sf):
    return cat.average_similar().of(tb.catalogue(spark, sf))


PERFORMANCE = f"""{RATED}, performance AS (
  SELECT {_case("n_similar", cat.ladders.SIMILAR_WIDE)} AS similar_category, count(*) AS book_count,
         {_round("avg(average_rating)")} AS avg_rating, {_round("avg(ratings_count)")} AS avg_engagement,
         {_round("avg(n_similar)")} AS avg_similar_count
  FROM rated WHERE n_similar IS NOT NULL AND average_rating IS NOT NULL AND ratings_count IS NOT NULL GROUP BY 1)"""


@query(f"WITH {PERFORMANCE} SELECT * FROM performance")
def similar_vs_performance(spark, sf):
    return cat.similar_vs_performance().of(tb.rated_catalogue(spark, sf))


@query(f"""WITH {PERFORMANCE} SELECT {_round("regr_slope(avg_rating, avg_similar_count)", 5)} AS slope,
  {_round("regr_intercept(avg_rating, avg_similar_count)", 5)} AS intercept FROM performance""")
def similar_trend(spark, sf):
    trend = cat.similar_trend(cat.similar_vs_performance().of(tb.rated_catalogue(spark, sf)))
    return trend.select(*[rounded(F.col(c), 5).alias(c) for c in trend.columns])


def _report_sql(report: str, source: str, value: str, ladder: Ladder, whole: str, where: str = "TRUE") -> str:
    return f"""SELECT '{report}' AS report, {_case(value, ladder)} AS bucket, count(*) AS book_count,
  {_pct("count(*)", f"(SELECT count({whole}) FROM {source} WHERE {where})")} AS percentage
  FROM {source} WHERE {value} IS NOT NULL AND {where} GROUP BY 2"""


@query(f"""WITH {RATED}, {SHELF_ROWS}, sizes AS (
  SELECT book_id AS b, count(*) AS n_shelves FROM shelf_rows GROUP BY book_id),
whole AS (SELECT rated.*, n_shelves FROM rated LEFT JOIN sizes ON book_id = b)
""" + " UNION ALL ".join([
    _report_sql("page_distribution", "whole", "num_pages", cat.ladders.PAGES, "*", "num_pages > 0"),
    _report_sql("series_count_distribution", "whole", "n_series", cat.ladders.SERIES, "*"),
    _report_sql("rating_distribution", "whole", "average_rating", cat.ladders.RATING, "average_rating"),
    _report_sql("engagement_distribution", "whole", "ratings_count", ENGAGEMENT, "ratings_count"),
    _report_sql("shelves_count_distribution", "whole", "n_shelves", cat.ladders.SHELVES, "*"),
    _report_sql("similar_books_distribution", "whole", "n_similar", cat.ladders.SIMILAR, "*")]))
def catalogue_report(spark, sf):
    return rp.histograms_together(tb.full_catalogue(spark, sf), [
        cat.page_distribution(), cat.series_distribution(), cat.rating_distribution(),
        cat.engagement_distribution(ladder=ENGAGEMENT), cat.shelves_distribution(),
        cat.similar_distribution()])


# ------------------------------------------------------------ tags and links

POPULARITY = f"""{SHELF_ROWS}, popularity AS (
  SELECT shelf_name, count(*) AS books_with_shelf, CAST(sum(shelf_count) AS BIGINT) AS total_shelf_count
  FROM shelf_rows GROUP BY shelf_name)"""


@query(f"WITH {POPULARITY} SELECT * FROM popularity")
def shelf_popularity(spark, sf):
    return tags.by_popularity(tags.tag_popularity(tb.shelves(spark, sf)))


@query(f"WITH {POPULARITY} SELECT * FROM popularity ORDER BY books_with_shelf DESC, shelf_name LIMIT 10")
def top_shelves(spark, sf):
    return tags.by_popularity(tags.tag_popularity(tb.shelves(spark, sf))).limit(10)


@query(f"WITH {POPULARITY} SELECT * FROM popularity ORDER BY total_shelf_count DESC, shelf_name LIMIT 10")
def most_used_shelves(spark, sf):
    return tags.by_usage(tags.tag_popularity(tb.shelves(spark, sf))).limit(10)


@query(f"""WITH {BOOKS}, edges AS (SELECT book_id, unnest(similar_books) AS similar_book_id FROM books)
SELECT similar_book_id, count(*) AS referenced_count FROM edges GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 50""")
def most_referenced(spark, sf):
    return tags.most_referenced(tb.catalogue(spark, sf))


GENERIC = ["nation_0", "nation_1", "nation_2", "nation_3", "nation_4", "nation_5", "nation_6", "nation_7"]
TOPICS = f"""WITH {SHELF_ROWS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY shelf_count DESC, shelf_name) AS place
  FROM shelf_rows WHERE shelf_name NOT IN ({", ".join(f"'{g}'" for g in GENERIC)}))
SELECT book_id, p_name AS title, string_agg(shelf_name, ',' ORDER BY place) AS topics
FROM ranked JOIN part ON book_id = p_partkey WHERE place <= 3 GROUP BY book_id, p_name"""


@query(TOPICS)
def top_topics(spark, sf):
    found = tags.top_topics(tb.shelved_catalogue(spark, sf), exclude=GENERIC)
    return found.withColumn("topics", F.array_join("topics", ","))


@query(TOPICS)
def top_topics_of_rows(spark, sf):
    rows = tags.flatten_tags(tb.shelved_catalogue(spark, sf), carry=["title"])
    found = tags.top_topics_of_rows(rows, exclude=GENERIC)
    return found.withColumn("topics", F.array_join("topics", ","))


@query(f"""WITH {SHELF_ROWS} SELECT shelf_name, count(*) AS books FROM shelf_rows
  WHERE shelf_name NOT IN ({", ".join(f"'{g}'" for g in GENERIC)}) AND shelf_count BETWEEN 2 AND 4 GROUP BY 1""")
def specific_shelves(spark, sf):
    rows = filters.exclude_values(tags.flatten_tags(tb.shelves(spark, sf)), "shelf_name", GENERIC)
    return rp.label_counts(filters.between(rows, "shelf_count", 2, 4), "shelf_name", "books")


# ------------------------------------------------------------------- filters

@query(f"WITH {BOOKS} SELECT num_pages, count(*) AS books FROM books WHERE num_pages > 0 GROUP BY 1")
def positive_pages(spark, sf):
    return rp.label_counts(filters.positive(tb.catalogue(spark, sf), "num_pages"), "num_pages", "books")


@query(f"""WITH {BOOKS} SELECT book_id, n_series, CAST(len(similar_books) AS INTEGER) AS n_similar FROM books
  WHERE n_series > 0 AND len(similar_books) > 0 AND description <> ''""")
def linked_series(spark, sf):
    books = filters.non_empty_text(tb.catalogue(spark, sf), "description")
    books = filters.non_empty_array(filters.non_empty_array(books, "series"), "similar_books")
    return books.selectExpr("book_id", "size(series) AS n_series", "size(similar_books) AS n_similar")


@query("""SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
  FROM documents LEFT JOIN labels USING (doc_id)""")
def zero_filled_labels(spark, sf):
    labelled = tb.table(spark, sf, "documents").select("doc_id").join(tb.table(spark, sf, "labels"), "doc_id", "left")
    return filters.fill_zero(labelled, ["quality", "toxic"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled_documents(spark, sf):
    documents = tb.table(spark, sf, "documents").select("doc_id")
    return filters.exclude_values(documents, "doc_id", tb.table(spark, sf, "labels"), hot={})     # ids are unique


# ------------------------------------------------------- curated subsets

@query(f"""WITH {RATINGS}, {BOOKS} SELECT book_id, user_id, rating, n_votes, date_added, title, num_pages
  FROM ratings JOIN books USING (book_id)""")
def reviews_with_books(spark, sf):
    books = tb.catalogue(spark, sf).select("book_id", "title", "num_pages")
    return etl.reviews_with_books(tb.ratings(spark, sf), books, hot=tb.hot_books(spark, sf))


@query("""SELECT doc_id AS book_id, doc_id % 50 AS user_id, text AS review_text, quality AS rating,
       n_chars AS n_votes, p_name AS title
FROM documents LEFT JOIN labels USING (doc_id) JOIN part ON doc_id = p_partkey WHERE length(text) > 10""")
def nlp_subset(spark, sf):
    books = tb.catalogue(spark, sf).select("book_id", "title")
    reviews = tb.rated(etl.with_text(tb.unrated_reviews(spark, sf)), spark, sf)
    return etl.nlp_subset(etl.reviews_with_books(reviews, books, hot={}))      # one review of each document


@query(f"""WITH {RATINGS}, {RATED}, {SHELF_ROWS}, listed AS (
  SELECT book_id AS b, string_agg(shelf_count || ':' || shelf_name, '|' ORDER BY CAST(shelf_count AS VARCHAR), shelf_name) AS s
  FROM shelf_rows GROUP BY book_id)
SELECT r.user_id, r.book_id, r.rating, title, s AS popular_shelves, n_series,
       array_to_string(similar_books, '|') AS similar_books, description, average_rating
FROM ratings r JOIN rated USING (book_id) LEFT JOIN listed ON r.book_id = b WHERE r.rating > 0""")
def rec_subset(spark, sf):
    full = etl.reviews_with_books(etl.with_rating(tb.ratings(spark, sf)), tb.full_catalogue(spark, sf),
                                  hot=tb.hot_books(spark, sf))
    shelf = F.transform("popular_shelves", lambda s: F.concat_ws(":", s["count"], s["name"]))
    return etl.rec_subset(full).select(
        "user_id", "book_id", "rating", "title", F.array_join(shelf, "|").alias("popular_shelves"),
        F.size("series").alias("n_series"), F.array_join("similar_books", "|").alias("similar_books"),
        "description", "average_rating")


@query(f"""WITH {RATED} SELECT book_id, title, num_pages, average_rating, ratings_count, text_reviews_count
  FROM rated WHERE ratings_count > 10 AND num_pages > 0""")
def eda_subset(spark, sf):
    return etl.eda_subset(tb.rated_catalogue(spark, sf)).select(
        "book_id", "title", "num_pages", "average_rating", "ratings_count", "text_reviews_count")


# Parts for the keys that the salted queries spread, present or not.
SPREAD = {1: 7, 2: 64, 3: 2, 100: 16, -1: 3}


@query(SQL["reviews_with_books"])
def reviews_with_books_salted(spark, sf):
    books = tb.catalogue(spark, sf).select("book_id", "title", "num_pages")
    return etl.reviews_with_books(tb.ratings(spark, sf), books, hot=SPREAD)


@query(SQL["unlabelled_documents"])
def unlabelled_documents_salted(spark, sf):
    documents = tb.table(spark, sf, "documents").select("doc_id")
    return filters.exclude_values(documents, "doc_id", tb.table(spark, sf, "labels"), hot=SPREAD)


# ------------------------------------------------------------------ keywords

# The texts are invented prose: these occur in it, but for one.
TERMS = ["tion", "the", "that", "thin", "with", "thing", "free", "license", "great", "war"]
HAS = {t: f"CASE WHEN contains(lower(text), '{t}') THEN 1 ELSE 0 END" for t in TERMS}
TOTAL = "(" + " + ".join(HAS.values()) + ")"
FREQUENCY = f"""WITH d AS (SELECT * FROM documents WHERE text IS NOT NULL AND text <> ''), frequency AS (""" + \
    " UNION ALL ".join(f"""SELECT '{t}' AS keyword, count(*) FILTER (WHERE {h} = 1) AS book_count,
      {_pct(f"count(*) FILTER (WHERE {h} = 1)", "count(*)")} AS percentage FROM d""" for t, h in HAS.items()) + ")"


@query(FREQUENCY + " SELECT * FROM frequency")
def keyword_frequency(spark, sf):
    return kw.keyword_frequency(tb.texts(spark, sf), keywords=TERMS)


@query("WITH " + ", ".join(f"w{i} AS (SELECT count(*) AS n FROM documents WHERE "
                           f"regexp_matches(lower(text), '(^|[^a-z0-9]){t}([^a-z0-9]|$)'))"
                           for i, t in enumerate(TERMS))
       + " " + " UNION ALL ".join(
           f"""SELECT '{t}' AS keyword, n AS book_count,
           {_pct("n", "(SELECT count(*) FROM documents WHERE text <> '')")} AS percentage FROM w{i}"""
           for i, t in enumerate(TERMS)))
def keyword_frequency_by_word(spark, sf):
    return kw.keyword_frequency(tb.texts(spark, sf), keywords=TERMS, match="word")


@query(FREQUENCY + " SELECT * FROM frequency ORDER BY book_count DESC, keyword LIMIT 5")
def keyword_top(spark, sf):
    return kw.rank_keywords(kw.keyword_report(keywords=TERMS).of(tb.texts(spark, sf)), 5)


@query(FREQUENCY + " SELECT * FROM frequency ORDER BY book_count, keyword LIMIT 5")
def keyword_bottom(spark, sf):
    return kw.rank_keywords(kw.keyword_report(keywords=TERMS).of(tb.texts(spark, sf)), 5, least=True)


@query(FREQUENCY + " SELECT keyword AS term, book_count AS weight FROM frequency")
def term_weights(spark, sf):
    return kw.term_weights(kw.keyword_report(keywords=TERMS).of(tb.texts(spark, sf)))


@query("SELECT doc_id AS book_id, " + ", ".join(f'{h} AS "has_{t}"' for t, h in HAS.items())
       + f", {TOTAL} AS total_keywords FROM documents WHERE text <> ''")
def keyword_flags(spark, sf):
    return kw.keyword_flags(tb.texts(spark, sf), keywords=TERMS)


@query(_histogram(f"counted AS (SELECT {TOTAL} AS total FROM documents WHERE text <> '')", "counted", "total",
                  cat.ladders.KEYWORD_DENSITY, "keyword_category", "*"))
def keyword_density(spark, sf):
    return cat.keyword_density(keywords=TERMS).of(tb.texts(spark, sf))


@query(f"SELECT {_round(f'avg({TOTAL})')} AS avg_keywords_per_book FROM documents WHERE text <> ''")
def average_keywords(spark, sf):
    return cat.average_keywords(keywords=TERMS).of(tb.texts(spark, sf))


# ----------------------------------------------------------------- sentiment

SQL_BLANKS = (r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
SQL_ALNUM = rf"regexp_replace(text, '[^a-zA-Z0-9{SQL_BLANKS}]', '', 'g')"
SQL_LETTERS = r"lower(regexp_replace(text, '[^a-zA-Z\t-\r ]', '', 'g'))"


@query(f"SELECT doc_id, {SQL_ALNUM} AS alnum, {SQL_LETTERS} AS letters FROM documents")
def clean_text(spark, sf):
    text = F.col("description")
    return tb.texts(spark, sf, costly=True).select(
        F.col("book_id").alias("doc_id"), alnum_only(text).alias("alnum"), letters_only(text).alias("letters"))


# Tenths, which no engine adds up without rounding, and a pair whose mean lies on the bound of a label.
POLARITIES = [("with", 0.1), ("that", -0.1), ("it", 0.2), ("was", -0.3), ("free", 0.75), ("great", 1.0),
              ("und", 0.1), ("que", -0.1), ("les", -0.2), ("this", 0.3), ("are", -0.05), ("by", -0.1)]
SCORED = f"""lexicon(word, units) AS (VALUES {", ".join(f"('{w}', {round(p * sn.UNITS)}::BIGINT)" for w, p in POLARITIES)}),
tokens AS (SELECT doc_id, unnest(regexp_split_to_array(lower({SQL_ALNUM}), '[{SQL_BLANKS}]+')) AS word FROM documents),
found AS (SELECT doc_id, CAST(sum(units) AS DOUBLE) / (count(*) * {float(sn.UNITS)}::DOUBLE) AS s
  FROM tokens JOIN lexicon USING (word) GROUP BY doc_id),
scored AS (SELECT d.doc_id AS book_id, doc_id % 50 AS user_id, source, quality AS rating, coalesce(s, 0.0::DOUBLE) AS sentiment_score
  FROM documents d LEFT JOIN labels USING (doc_id) LEFT JOIN found USING (doc_id)),
labelled AS (SELECT *, CASE WHEN sentiment_score >= 0.1 THEN 'POSITIVE' WHEN sentiment_score <= -0.1 THEN 'NEGATIVE'
  ELSE 'NEUTRAL' END AS sentiment_label FROM scored)"""
INSIGHTS = f"""{SCORED}, insights AS (
  SELECT source, {_round("avg(sentiment_score)", 5)} AS avg_sentiment, {_round("avg(rating)", 5)} AS avg_rating,
         count(sentiment_score) AS review_count FROM labelled GROUP BY source HAVING count(sentiment_score) > 20)"""


def _scored(spark, sf, **options):
    lexicon = files.literal_rows(spark, POLARITIES, LEXICON)
    scored = sn.score_reviews(tb.unrated_reviews(spark, sf, costly=True), lexicon, **options).drop("review_text")
    return tb.rated(scored, spark, sf)


def _insights(spark, sf):
    insights = sn.group_insights(_scored(spark, sf), keys=["source"])
    return insights.select("source", rounded(F.col("avg_sentiment"), 5).alias("avg_sentiment"),
                           rounded(F.col("avg_rating"), 5).alias("avg_rating"), "review_count")


@query(f"WITH {SCORED} SELECT * FROM labelled")
def sentiment_scores(spark, sf):
    return _scored(spark, sf).select("book_id", "user_id", "source", "rating", "sentiment_score", "sentiment_label")


@query(f"WITH {SCORED} SELECT * FROM labelled")
def sentiment_scores_shuffled(spark, sf):
    """The lexicon joined as a table too large to broadcast would be."""
    return _scored(spark, sf, strategy="merge").select("book_id", "user_id", "source", "rating", "sentiment_score",
                                                       "sentiment_label")


@query(f"WITH {SCORED} SELECT sentiment_label, count(*) AS n FROM labelled GROUP BY 1")
def sentiment_labels(spark, sf):
    return rp.label_counts(_scored(spark, sf), "sentiment_label", "n")


@query(f"WITH {INSIGHTS} SELECT * FROM insights")
def sentiment_insights(spark, sf):
    return sn.by_sentiment(_insights(spark, sf), keys=["source"])


@query(f"WITH {INSIGHTS} SELECT * FROM insights ORDER BY avg_sentiment DESC, source LIMIT 10")
def sentiment_top(spark, sf):
    return sn.by_sentiment(_insights(spark, sf), 10, keys=["source"])


# --------------------------------------------------------------- recommender

def _deduped(spark, sf) -> DataFrame:
    return rt.dedupe_ratings(tb.titled_ratings(spark, sf))


@query(f"WITH {DEDUPED} SELECT * FROM deduped")
def dedupe_ratings(spark, sf):
    return _deduped(spark, sf)


def _supported(min_user: int, min_item: int) -> str:
    return f"""{DEDUPED}, kept AS (SELECT * FROM deduped
  WHERE user_id IN (SELECT user_id FROM deduped GROUP BY 1 HAVING count(*) >= {min_user})
    AND book_id IN (SELECT book_id FROM deduped GROUP BY 1 HAVING count(*) >= {min_item}))"""


@query(f"WITH {_supported(5, 10)} SELECT * FROM kept")
def support_filter(spark, sf):
    return rt.support_filter(materialise(_deduped(spark, sf)))


@query(f"WITH {_supported(30, 24)} SELECT * FROM kept")
def support_filter_strict(spark, sf):
    return rt.support_filter(materialise(_deduped(spark, sf)), min_user=30, min_item=24)


@query(SQL["support_filter"])
def support_filter_salted(spark, sf):
    return rt.support_filter(materialise(_deduped(spark, sf)), hot={"user_id": SPREAD, "book_id": SPREAD})


INDEXED = f"""{_supported(5, 10)},
users AS (SELECT user_id, CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS user_idx
          FROM kept GROUP BY user_id),
items AS (SELECT book_id, CAST(row_number() OVER (ORDER BY count(*) DESC, book_id) - 1 AS INTEGER) AS book_idx
          FROM kept GROUP BY book_id)"""


def _indexed(spark, sf) -> DataFrame:
    deduped = materialise(rt.dedupe_ratings(tb.ratings(spark, sf), title=None))
    hot = rt.hot_ids(deduped)
    return rt.index_ids(materialise(rt.support_filter(deduped, hot=hot)), hot=hot)


@query(f"""WITH {INDEXED} SELECT user_id, user_idx, book_id, book_idx, rating
  FROM kept JOIN users USING (user_id) JOIN items USING (book_id)""")
def index_ids(spark, sf):
    return _indexed(spark, sf).select("user_id", "user_idx", "book_id", "book_idx", "rating")


@query(f"""WITH {DEDUPED} SELECT CASE WHEN (user_id * 31 + book_id * 17) % 100 < 80 THEN 'train' ELSE 'test' END AS side,
  count(*) AS n, {_round("avg(rating)", 5)} AS avg_rating FROM deduped GROUP BY 1""")
def split_counts(spark, sf):
    bucket = (F.col("user_id") * 31 + F.col("book_id") * 17) % 100
    train, test = rt.split(_deduped(spark, sf), bucket=bucket)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("rating"), 5).alias("avg_rating"))


@query()
def als_metrics(spark, sf):
    train, test = rt.split(materialise(_indexed(spark, sf)))
    return rec.als_metrics(rec.fit_als(train), test)


@query()
def als_recommendations(spark, sf):
    indexed = materialise(_indexed(spark, sf))
    train, _ = rt.split(indexed)
    titles = rt.item_titles(tb.titled_ratings(spark, sf))
    return rec.recommend(rec.fit_als(train), indexed, titles)


@query(f"""WITH {RATINGS} SELECT book_id, max(p_name) AS title FROM ratings JOIN part ON book_id = p_partkey
  WHERE rating > 0 GROUP BY book_id""")
def item_titles(spark, sf):
    return rt.item_titles(tb.titled_ratings(spark, sf))


# ---------------------------------------------------------------- clustering

@query()
def keyword_clusters(spark, sf):
    return clustering.keyword_clusters(tb.texts(spark, sf, costly=True), keywords=TERMS)[0]


@query()
def feature_clusters(spark, sf):
    return clustering.feature_clusters(tb.rated_catalogue(spark, sf), k=8)[0]


@query()
def text_clusters(spark, sf):
    return clustering.text_clusters(tb.texts(spark, sf, costly=True), k=8)[0]


@query()
def cluster_sizes(spark, sf):
    return clustering.cluster_sizes(clustering.feature_clusters(tb.rated_catalogue(spark, sf), k=8)[0])


@query(f"""WITH {RATED} SELECT 'keywords' AS clustering, count(*) AS records FROM documents WHERE {SQL_LETTERS} <> ''
  UNION ALL SELECT 'numbers', count(*) FROM rated""")
def clustered_records(spark, sf):
    """Every record that has something to go by is in exactly one cluster."""
    sizes = {"keywords": clustering.keyword_clusters(tb.texts(spark, sf, costly=True), keywords=TERMS)[0],
             "numbers": clustering.feature_clusters(tb.rated_catalogue(spark, sf), k=8)[0]}
    totals = [clustering.cluster_sizes(frame).agg(F.sum("count").alias("records"))
              .select(F.lit(name).alias("clustering"), "records") for name, frame in sizes.items()]
    return totals[0].unionByName(totals[1])


@query()
def tfidf_features(spark, sf):
    return clustering.tfidf_features(tb.texts(spark, sf, costly=True))[0].select("book_id", "title", F.col("features").cast("string"))


@query()
def lda_topics(spark, sf):
    return clustering.lda_topics(tb.texts(spark, sf, costly=True))[0].select("book_id", "title", "topic", "weight")


# ------------------------------------------------------------ files and index

@query(f"""WITH {RATED} SELECT '{{"index":{{"_index":"catalogue","_id":' || book_id || '}}}}' || chr(10) ||
  '{{"title":' || to_json(title) || ',"description":' || to_json(description) || ',"average_rating":' ||
  coalesce(to_json(average_rating), 'null') || ',"similar_books":' || coalesce(to_json(similar_books), 'null') || '}}' AS value
  FROM rated""")
def bulk_index_lines(spark, sf):
    return files.bulk_index_lines(tb.rated_catalogue(spark, sf), "catalogue")


DOCUMENT_COLUMNS = (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                    ("n_chars", "bigint"))


@query(" UNION ALL ".join(f"SELECT 'column' AS what, {i} AS position, '{c}' AS name, '{t}' AS value"
                          for i, (c, t) in enumerate(DOCUMENT_COLUMNS))
       + """ UNION ALL SELECT 'first', CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER), CAST(doc_id AS VARCHAR), source
  FROM (SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 5)
  UNION ALL SELECT 'rows', 0, '', CAST(count(*) AS VARCHAR) FROM documents""")
def profile_table(spark, sf):
    """The columns with their types, the first five rows by id, and the row count, as one table."""
    schema, head, count = files.profile_table(tb.table(spark, sf, "documents"), 5, key=["doc_id"])
    columns = schema.selectExpr("'column' AS what", "position", "column AS name", "type AS value")
    ranked = head.select("source", "doc_id", F.row_number().over(Window.orderBy("doc_id")).alias("n"))
    first = ranked.selectExpr("'first' AS what", "n - 1 AS position", "string(doc_id) AS name", "source AS value")
    total = count.selectExpr("'rows' AS what", "0 AS position", "'' AS name", "string(row_count) AS value")
    return columns.unionByName(first).unionByName(total)
