"""The jobs end to end, on files."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from data import RAW_BOOKS, RAW_REVIEWS, review
from shelfmark.functions.text import KEYWORDS
from shelfmark.operators import reports as rp
from shelfmark.plans import index, prepare, recommend, sentiment, statistics, topics
from shelfmark.schemas import LEXICON, RAW_BOOKS as BOOK_SCHEMA
from shelfmark.sources import files


def write_lines(path, rows, extra=()):
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)
        out.writelines(line + "\n" for line in extra)


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("prepared")
    raw = folder / "raw"
    raw.mkdir()
    write_lines(raw / "a_books_1.json", RAW_BOOKS[:6], extra=['{"book_id": "broken'])
    write_lines(raw / "a_books_2.json", RAW_BOOKS[6:])
    many = [review(str(b), f"u{u}", text="good " * (u + 3) + "bad", rating=str(1 + (u + b) % 5))
            for b in range(3, 8) for u in range(25)]
    write_lines(raw / "the_reviews.json", RAW_REVIEWS + many)
    out = str(folder / "out")
    counts = {r["what"]: r["rows"] for r in prepare.run(spark, str(raw), out).collect()}
    return out, counts, len(many)


def test_prepare(spark, prepared):
    out, counts, many = prepared
    assert counts == {"joined reviews": 5 + many, "books": 11, "distinct books": 11}
    nlp = spark.read.parquet(f"{out}/nlp/parquet")
    assert nlp.columns == ["book_id", "user_id", "review_text", "rating", "n_votes", "title"]
    short = {r["review_text"] for r in nlp.filter("book_id IN ('1', '2')").collect()}
    assert short == {"0123456789a", "good, good bad"}
    rec = spark.read.parquet(f"{out}/recommender/parquet")
    assert rec.columns == ["user_id", "book_id", "rating", "title", "popular_shelves", "series",
                           "similar_books", "description", "average_rating"]
    assert rec.filter("book_id IN ('1', '2')").count() == 3 and rec.filter("rating <= 0").count() == 0
    eda = spark.read.parquet(f"{out}/eda/parquet")
    assert {r["book_id"] for r in eda.collect()} == {"1", "2", "3", "4", "5", "6", "7"}
    assert dict(eda.dtypes)["average_rating"] == "double" and dict(eda.dtypes)["num_pages"] == "int"


def test_samples_are_single_files(spark, prepared):
    out = prepared[0]
    for name, rows in (("nlp", spark.read.parquet(f"{out}/nlp/parquet").count()), ("eda", 7)):
        folder = f"{out}/{name}/sample_json"
        assert len([f for f in os.listdir(folder) if f.endswith(".json")]) == 1
        assert spark.read.json(folder).count() == rows


def test_statistics(spark, prepared, tmp_path):
    reports = statistics.run(spark, f"{prepared[0]}/eda/parquet", str(tmp_path))
    written = set(os.listdir(tmp_path))
    assert {"page_distribution", "series_count_distribution", "rating_distribution", "rating_stats",
            "engagement_distribution", "quality_vs_engagement", "shelves_count_distribution",
            "shelf_popularity", "most_used_shelves", "similar_books_distribution", "similar_vs_performance",
            "most_referenced_books", "keyword_count_distribution"} <= written
    pages = spark.read.option("header", True).csv(f"{tmp_path}/page_distribution")
    assert pages.columns == ["page_category", "book_count", "percentage"]
    assert sum(int(r["book_count"]) for r in pages.collect()) == 7
    assert reports["keyword_frequency"].count() == 32
    assert reports["dataset_counts"].first()["distinct_keys"] == 7


def test_measures_fit_one_codegen_stage(spark, prepared):
    books = spark.read.parquet(f"{prepared[0]}/eda/parquet")
    for group in (statistics.profile_reports(), statistics.text_reports(KEYWORDS)):
        measured = rp.measure(books, group)
        measured.collect()
        plan = measured._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1
        assert re.search(r"\*\(1\) HashAggregate", plan)


def test_sentiment(spark, prepared, tmp_path):
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], LEXICON)
    charts = sentiment.run(spark, f"{prepared[0]}/nlp/parquet", lexicon, str(tmp_path))
    scored = spark.read.parquet(f"{tmp_path}/scored/parquet")
    assert scored.columns == ["book_id", "user_id", "review_text", "rating", "n_votes", "title",
                              "sentiment_score", "sentiment_label"]
    insights = spark.read.parquet(f"{tmp_path}/insights/parquet")
    assert insights.count() == 5 and insights.filter("review_count <= 20").count() == 0
    assert spark.read.json(f"{tmp_path}/insights/json_top_books").count() == 5
    reviews = spark.read.json(f"{tmp_path}/scored/json_reviews")
    assert reviews.count() == scored.count() and {"title", "sentiment_label", "sentiment_score"} <= set(reviews.columns)
    assert sum(r["count"] for r in charts["sentiment_distribution"].collect()) == scored.count()
    assert charts["top_books"].count() == 5


def test_lexicon_file(spark, tmp_path):
    (tmp_path / "lexicon.csv").write_text("word,polarity\ngood,0.7\n")
    assert [tuple(r) for r in sentiment.read_lexicon(spark, str(tmp_path / "lexicon.csv")).collect()] == [("good", 0.7)]


def test_recommend(spark, prepared, tmp_path):
    metrics = recommend.run(spark, f"{prepared[0]}/recommender/parquet", str(tmp_path), k=3, rank=3, max_iter=3)
    assert metrics.count() == 1 and metrics.first()["rank"] == 3
    recs = spark.read.parquet(f"{tmp_path}/als_recommendations")
    assert recs.count() == 3 * 25
    assert recs.filter("title IS NULL OR user_id IS NULL").count() == 0


def test_topics_from_the_json_sample(spark, prepared, tmp_path):
    sizes = topics.run(spark, f"{prepared[0]}/eda/sample_json", str(tmp_path), json=True,
                       keyword_k=2, feature_k=2, text_k=2, lda_k=2)
    assert sum(r["count"] for r in sizes["feature_clusters"].collect()) == 7
    shelf = spark.read.parquet(f"{tmp_path}/shelf_topics")
    assert shelf.columns == ["book_id", "title", "topics"] and shelf.filter("size(topics) > 3").count() == 0


def test_index_lines(spark, tmp_path):
    rows = [(str(i), None if i == 1 else f'"quoted"\n{i}', 1.5, ["7"]) for i in range(1203)]
    books = spark.createDataFrame(rows, "book_id string, title string, average_rating double, similar_books array<string>")
    books = books.withColumn("description", F.lit("d"))
    books.coalesce(1).write.parquet(str(tmp_path / "books"))
    index.run(spark, str(tmp_path / "books"), str(tmp_path / "bodies"), "shop")
    bodies = spark.read.json(str(tmp_path / "bodies")).collect()
    assert sorted(b["documents"] for b in bodies) == [203, 500, 500]
    index.run(spark, str(tmp_path / "books"), str(tmp_path / "bulk"), "shop", docs_per_file=500)
    seen = {}
    for name in os.listdir(tmp_path / "bulk"):
        if not name.startswith("part-"):
            continue
        lines = (tmp_path / "bulk" / name).read_text(encoding="utf-8").splitlines()
        assert len(lines) <= 1000 and len(lines) % 2 == 0
        for action, document in zip(lines[::2], lines[1::2]):
            target = json.loads(action)["index"]
            assert target["_index"] == "shop" and target["_id"] not in seen
            seen[target["_id"]] = json.loads(document)
    assert len(seen) == 1203
    assert seen["1"] == {"title": None, "description": "d", "average_rating": 1.5, "similar_books": ["7"]}
    assert seen["2"]["title"] == '"quoted"\n2'


def test_sample_rows(spark):
    df = spark.range(60_000).withColumn("x", F.col("id") % 7)
    some = files.sample_rows(df, 100, ["id"])
    ids = [r["id"] for r in some.collect()]
    assert len(ids) == 100 and len(set(ids)) == 100
    assert sorted(ids) == sorted(r["id"] for r in files.sample_rows(df.repartition(5), 100, ["id"]).collect())
    whole = df.orderBy(F.xxhash64("id"), "id").limit(100).collect()
    assert ids == [r["id"] for r in whole]
    assert files.sample_rows(df.limit(30), 100, ["id"]).count() == 30
    # one key only: the hash bound would find nothing, so it must not be used
    assert files.sample_rows(df.withColumn("k", F.lit(1)), 100, ["k"]).count() == 100


def test_profile_table(spark):
    df = spark.createDataFrame([(i, "x") for i in range(9)], "a int, b string")
    schema, head, count = files.profile_table(df)
    assert [(r["column"], r["type"]) for r in schema.collect()] == [("a", "int"), ("b", "string")]
    assert head.count() == 5 and count.first()["row_count"] == 9


def test_declared_schema_accepts_numbers_and_strings(spark, tmp_path):
    write_lines(tmp_path / "b.json", RAW_BOOKS)
    raw = files.read_json(spark, str(tmp_path / "b.json"), BOOK_SCHEMA)
    pages = {r["book_id"]: r["num_pages"] for r in raw.collect()}
    assert pages["7"] == "1" and pages["1"] == "99" and pages["8"] == ""
