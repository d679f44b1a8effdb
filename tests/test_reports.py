import pytest
from pyspark.sql import functions as F

from data import RAW_BOOKS
from shelfmark.functions.ladders import ENGAGEMENT, KEYWORD_DENSITY, PAGES, RATING, SHELVES
from shelfmark.functions.numbers import percent_sql, rounded
from shelfmark.operators import catalogue as cat, etl, filters, keywords as kw, reports as rp, tags
from shelfmark.plans import file_checks
from shelfmark.schemas import RAW_BOOKS as SCHEMA


@pytest.fixture(scope="module")
def books(spark):
    rows = [{**b, **{k: None if b[k] is None else str(b[k])
                     for k in ("average_rating", "num_pages", "ratings_count", "text_reviews_count")}}
            for b in RAW_BOOKS]
    return etl.normalize_books(spark.createDataFrame(rows, SCHEMA)).cache()


def table(frame, key, value="book_count"):
    return {r[key]: r[value] for r in frame.collect()}


def test_dirty_numbers_become_null(books):
    pages = table(books, "book_id", "num_pages")
    assert pages["8"] is None and pages["11"] is None and pages["9"] == 0 and pages["7"] == 1


def test_page_bounds(books):
    counts = table(cat.page_distribution().of(books), "page_category")
    assert counts == {"Very Short (<100)": 2, "Short (100-200)": 2, "Medium-Short (200-300)": 1,
                      "Long (500-700)": 1, "Very Long (700+)": 1}


def test_rows_come_in_declared_order_without_a_sort(books):
    got = [r["page_category"] for r in cat.page_distribution().of(books).collect()]
    assert got == [label for label in PAGES.labels if label in got]


def test_rating_bounds(books):
    counts = table(cat.rating_distribution().of(books), "rating_bucket")
    assert counts == {"0.0-1.0": 2, "1.0-2.0": 1, "2.0-3.0": 1, "3.0-4.0": 4, "4.0-5.0": 1, "5.0": 1}


def test_engagement_bounds(books):
    counts = table(cat.engagement_distribution().of(books), "engagement_level")
    assert counts == {"Very Low (<100)": 3, "Low (100-1K)": 2, "Medium (1K-10K)": 2,
                      "High (10K-100K)": 1, "Very High (100K-1M)": 1, "Extremely High (1M+)": 1}


def test_series_percentages_are_of_all_books(books):
    rows = cat.series_distribution().of(books).collect()
    assert sum(r["book_count"] for r in rows) == 10      # one book has no array at all
    assert rows[0]["series_category"] == "No Series" and rows[0]["percentage"] == 54.55
    assert round(sum(r["percentage"] for r in rows), 1) == 90.9


def test_splits_add_up(books):
    for report in (cat.series_split(), cat.shelves_split(), cat.similar_split()):
        assert sum(table(report.of(books), "group").values()) == len(RAW_BOOKS)
    assert table(cat.similar_split().of(books), "group")["Books with Similar Books"] == 9


def test_array_size_buckets(books):
    shelves = table(cat.shelves_distribution().of(books), "shelves_category")
    assert shelves == {"No Shelves": 3, "1-5 Shelves": 3, "6-10 Shelves": 1, "11-20 Shelves": 1,
                       "21-50 Shelves": 1, "50+ Shelves": 1}
    similar = table(cat.similar_distribution().of(books), "similar_category")
    assert similar == {"No Similar Books": 1, "1-5 Similar": 2, "6-10 Similar": 2, "11-20 Similar": 2,
                       "21-50 Similar": 2, "50+ Similar": 1}


def test_wide_buckets_agree_with_narrow_ones(books):
    rated = books.filter(F.col("average_rating").isNotNull() & F.col("ratings_count").isNotNull())
    narrow = table(cat.similar_distribution().of(rated), "similar_category")
    wide = table(cat.similar_vs_performance().of(books), "similar_category")
    assert wide["1-10 Similar"] == narrow["1-5 Similar"] + narrow["6-10 Similar"]


def test_crosstab_and_matrix_hold_the_same_cells(books):
    cells = cat.quality_vs_engagement().of(books).collect()
    assert cells == sorted(cells, key=lambda r: (r["rating_quality"], r["engagement_level"]))
    known = books.dropna(subset=["average_rating", "ratings_count"]).count()
    assert sum(r["book_count"] for r in cells) == known
    matrix = {r["rating_quality"]: r.asDict() for r in cat.quality_matrix().of(books).collect()}
    assert list(matrix) == ["Low (< 3.0)", "Medium (3.0-4.0)", "High (4.0+)"]
    for r in cells:
        assert matrix[r["rating_quality"]][r["engagement_level"]] == r["book_count"]
    assert sum(v for row in matrix.values() for k, v in row.items() if k != "rating_quality") == known


def test_summary(books):
    row = cat.page_summary().of(books).first()
    assert (row["min_pages"], row["max_pages"], row["median_pages"]) == (1, 700, 199)
    assert row["min_pages"] <= row["q1_pages"] <= row["median_pages"] <= row["q3_pages"] <= row["max_pages"]
    assert row["mean_median_gap"] == round(row["mean_pages"] - row["median_pages"], 2)


def test_missing(books):
    missing = table(cat.missing_values().of(books), "column", "missing")
    assert missing == {"description": 6, "authors": 1, "popular_shelves": 4, "average_rating": 1}


def test_key_uniqueness_counts_null_as_a_value(spark):
    row = rp.key_uniqueness(spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int"), "k").first()
    assert (row["total_rows"], row["distinct_keys"]) == (4, 2)
    empty = rp.key_uniqueness(spark.createDataFrame([], "k int"), "k").first()
    assert (empty["total_rows"], empty["distinct_keys"]) == (0, 0)


def test_many_reports_from_one_scan_equal_each_alone(books):
    reports = [cat.page_distribution(), cat.rating_summary(), cat.quality_matrix(), cat.keyword_density(),
               kw.keyword_report(), cat.similar_vs_performance()]
    measured = rp.measure(books, reports)
    assert measured.count() == 1
    for report in reports:
        assert report.read(measured).collect() == report.of(books).collect()


def test_one_scan_in_the_plan(books, capsys, spark, tmp_path):
    books.write.parquet(str(tmp_path / "books"))
    stored = spark.read.parquet(str(tmp_path / "books"))
    rp.histograms_together(stored, [cat.page_distribution(), cat.rating_distribution()]).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "average_rating:double,num_pages:int>" in plan


def test_trend_goes_through_the_points(spark):
    line = rp.linear_trend(spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (2.0, 5.0)], "x double, y double"),
                           "x", "y").first()
    assert (line["slope"], line["intercept"]) == (2.0, 1.0)


def test_keyword_matching(books):
    by_substring = table(kw.keyword_frequency(books), "keyword")
    assert by_substring["war"] == 1 and by_substring["award"] == 1      # both from "toward award"
    assert by_substring["self-help"] == 1 and by_substring["world"] == 1 and by_substring["love"] == 0
    by_word = table(kw.keyword_frequency(books, match="word"), "keyword")
    assert by_word["war"] == 0 and by_word["award"] == 1 and by_word["self-help"] == 1
    ranked = [r["book_count"] for r in kw.keyword_frequency(books).collect()]
    assert len(ranked) == 32 and ranked == sorted(ranked, reverse=True)


def test_keyword_flags_agree_with_counts(books):
    flags = kw.keyword_flags(books)
    total = flags.agg(F.sum("total_keywords")).first()[0]
    counts = kw.keyword_report().of(books).agg(F.sum("book_count")).first()[0]
    assert total == counts
    assert flags.count() == 5
    assert "has_self-help" in flags.columns
    mean = cat.average_keywords().of(books).first()[0]
    assert mean == round(total / 5, 2)


def test_no_texts_give_zero_percent(books):
    rows = kw.keyword_frequency(books.filter("book_id = '6'")).collect()
    assert {r["percentage"] for r in rows} == {0.0}


def test_ladder_bounds(spark):
    df = spark.createDataFrame([(0,), (15,), (16,), (None,)], "n int")
    assert [r[0] for r in df.select(F.expr(KEYWORD_DENSITY.label("n"))).collect()] == \
        ["0 keywords", "11-15 keywords", "15+ keywords", None]
    assert [r[0] for r in df.select(F.expr(KEYWORD_DENSITY.ordinal("n"))).collect()] == [0, 4, 5, None]
    assert len(SHELVES.labels) == 6 and len(ENGAGEMENT.labels) == 6 and len(RATING.labels) == 6


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(20.005,), (1.005,), (2.675,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"))).collect()] == [20.01, 1.01, 2.68]
    assert spark.range(1).selectExpr(percent_sql("1", "0")).first()[0] is None


# ------------------------------------------------------------------ tags, links

def test_tag_popularity(books):
    rows = {r["shelf_name"]: r for r in tags.tag_popularity(books).collect()}
    assert rows["to-read"]["books_with_shelf"] == 2 and rows["to-read"]["total_shelf_count"] == 93
    assert rows["c"]["total_shelf_count"] is None            # its only count is no number
    assert rows["s0"]["books_with_shelf"] == 5


def test_top_topics(books):
    topics = table(tags.top_topics(books), "book_id", "topics")
    assert topics["1"] == ["a", "b", "c"]                    # a tie by name; no usable count comes last
    assert "2" not in topics and "6" not in topics and "9" not in topics
    assert topics["8"] == ["s50", "s49", "s48"]
    rows = tags.flatten_tags(books, carry=["title"])
    assert table(tags.top_topics_of_rows(rows), "book_id", "topics") == topics
    assert table(tags.top_topics(books, exclude=[]), "book_id", "topics")["1"] == ["to-read", "a", "b"]


def test_references(books):
    counts = table(tags.reference_counts(books), "similar_book_id", "referenced_count")
    assert counts["0"] == 9 and counts["50"] == 1
    top = tags.most_referenced(books, k=3).collect()
    assert [r["referenced_count"] for r in top] == [9, 8, 8]
    assert sum(counts.values()) == 1 + 5 + 6 + 10 + 11 + 20 + 21 + 50 + 51


# --------------------------------------------------------------------- filters

def test_filters(spark, books):
    assert filters.positive(books, "num_pages").count() == 7
    assert filters.non_empty_array(books, "series").count() == 4
    assert filters.non_empty_text(books, "description").count() == 5
    assert filters.between(books, "ratings_count", 11, 100).count() == 3
    tags_ = tags.flatten_tags(books.filter("book_id = '1'"))
    kept = filters.exclude_values(tags_, "shelf_name", ["to-read"])
    assert kept.count() == 3
    listed = spark.createDataFrame([("to-read",), ("a",)], "shelf_name string")
    assert filters.exclude_values(tags_, "shelf_name", listed).count() == 2
    filled = filters.fill_zero(books.select("book_id", "num_pages"))
    assert filled.filter("num_pages IS NULL").count() == 0


def test_label_counts_in_order_has_every_label(spark, tmp_path):
    labels = [f"source {k:04}" for k in range(2500)]
    rows = [(label,) for k, label in enumerate(labels) for _ in range(1 + k % 3)] + [(None,)]
    spark.createDataFrame(rows, "source string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = file_checks.label_counts_in_order(spark, str(tmp_path)).collect()
    assert sorted((r["position"], r["source"], r["n"]) for r in got) == [
        (k, label, 1 + k % 3) for k, label in enumerate(labels)] + [(2500, None, 1)]
