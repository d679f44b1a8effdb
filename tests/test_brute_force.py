"""Operators on random nested records against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import ladders
from shelfmark.functions.text import GENERIC_SHELVES, KEYWORDS
from shelfmark.operators import catalogue as cat, keywords as kw, reports as rp, tags
from shelfmark.schemas import CURATED_BOOKS


def a_book(rng, i):
    names = [*GENERIC_SHELVES[:4], *[f"s{n}" for n in range(12)]]
    shelves = [{"name": n, "count": rng.choice(["1", "2", "3", "30", "", "x", None])}
               for n in rng.sample(names, rng.randint(0, 12))]
    # every third link goes to the same item
    links = [str(rng.choice([0, rng.randint(1, 40), rng.randint(1, 40)])) for _ in range(rng.randint(0, 60))]
    text = " ".join(rng.choice([*KEYWORDS, "Xyz", "TOWARD", "lovely"]) for _ in range(rng.randint(0, 25)))
    return {"book_id": str(i), "title": f"T{i}", "authors": [], "description": rng.choice([text, text.upper(), None]),
            "average_rating": rng.choice([None, round(rng.uniform(0, 5), 2), 3.0, 4.0, 5.0]),
            "num_pages": rng.choice([None, 0, 99, 100, 700, rng.randint(1, 900)]),
            "ratings_count": rng.choice([None, 99, 100, 1000, 10_000, 10 ** rng.randint(0, 7)]),
            "text_reviews_count": rng.randint(0, 9), "popular_shelves": rng.choice([shelves, shelves, None]),
            "series": [], "similar_books": rng.choice([links, links, links, None])}


@pytest.fixture(scope="module", params=[1, 2])
def records(request):
    rng = random.Random(request.param)
    return [a_book(rng, i) for i in range(300)]


@pytest.fixture()
def books(spark, records):
    return spark.createDataFrame(records, CURATED_BOOKS)


def step(ladder, value):
    for bound, label in ladder.steps:
        if value <= bound if ladder.inclusive else value < bound:
            return label
    return ladder.top


def number(text):
    return int(text) if text and text.isdigit() else None


def test_distributions(books, records):
    values = {
        "page_distribution": (ladders.PAGES, [r["num_pages"] for r in records if (r["num_pages"] or 0) > 0], None),
        "rating_distribution": (ladders.RATING, [r["average_rating"] for r in records
                                                 if r["average_rating"] is not None], None),
        "engagement_distribution": (ladders.ENGAGEMENT, [r["ratings_count"] for r in records
                                                         if r["ratings_count"] is not None], None),
        "shelves_count_distribution": (ladders.SHELVES, [len(r["popular_shelves"]) for r in records
                                                         if r["popular_shelves"] is not None], len(records)),
        "similar_books_distribution": (ladders.SIMILAR, [len(r["similar_books"]) for r in records
                                                         if r["similar_books"] is not None], len(records))}
    expected = {}
    for report, (ladder, numbers, whole) in values.items():
        for label, n in Counter(step(ladder, v) for v in numbers).items():
            expected[report, label] = (n, 100 * n / (whole or len(numbers)))
    got = rp.histograms_together(books, [cat.page_distribution(), cat.rating_distribution(),
                                         cat.engagement_distribution(), cat.shelves_distribution(),
                                         cat.similar_distribution()]).collect()
    assert {(r["report"], r["bucket"]): r["book_count"] for r in got} == {k: v[0] for k, v in expected.items()}
    for r in got:
        assert r["percentage"] == pytest.approx(expected[r["report"], r["bucket"]][1], abs=0.00501)


def test_performance(books, records):
    groups = {}
    for r in records:
        if None not in (r["similar_books"], r["average_rating"], r["ratings_count"]):
            groups.setdefault(step(ladders.SIMILAR_WIDE, len(r["similar_books"])), []).append(r)
    got = {r["similar_category"]: r for r in cat.similar_vs_performance().of(books).collect()}
    assert {k: r["book_count"] for k, r in got.items()} == {k: len(g) for k, g in groups.items()}
    for label, group in groups.items():
        assert got[label]["avg_rating"] == pytest.approx(
            sum(r["average_rating"] for r in group) / len(group), abs=0.00501)
        assert got[label]["avg_similar_count"] == pytest.approx(
            sum(len(r["similar_books"]) for r in group) / len(group), abs=0.00501)


def test_topics(books, records):
    expected = {}
    for r in records:
        usable = [s for s in r["popular_shelves"] or [] if s["name"] not in GENERIC_SHELVES]
        ranked = sorted(usable, key=lambda s: (number(s["count"]) is None, -(number(s["count"]) or 0), s["name"]))
        if ranked:
            expected[r["book_id"]] = [s["name"] for s in ranked[:3]]
    assert {r["book_id"]: r["topics"] for r in tags.top_topics(books).collect()} == expected
    flat = tags.top_topics_of_rows(tags.flatten_tags(books, carry=["title"]))
    assert {r["book_id"]: r["topics"] for r in flat.collect()} == expected


def test_popularity_and_links(books, records):
    carried, used, linked = Counter(), {}, Counter()
    for r in records:
        linked.update(r["similar_books"] or [])
        for s in r["popular_shelves"] or []:
            carried[s["name"]] += 1
            if number(s["count"]) is not None:
                used[s["name"]] = used.get(s["name"], 0) + number(s["count"])
    got = tags.tag_popularity(books).collect()
    assert {r["shelf_name"]: r["books_with_shelf"] for r in got} == carried
    assert {r["shelf_name"]: r["total_shelf_count"] for r in got} == {n: used.get(n) for n in carried}
    top = [(r["similar_book_id"], r["referenced_count"]) for r in tags.most_referenced(books, 10).collect()]
    assert top == sorted(linked.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert top[0][0] == "0"


def test_keywords(books, records):
    texts = {r["book_id"]: r["description"].lower() for r in records if r["description"]}
    counts = {k: sum(k in t for t in texts.values()) for k in KEYWORDS}
    assert {r["keyword"]: r["book_count"] for r in kw.keyword_frequency(books).collect()} == counts
    whole = {k: sum(k in t.split(" ") for t in texts.values()) for k in KEYWORDS}
    by_word = kw.keyword_frequency(books, match="word").collect()
    assert {r["keyword"]: r["book_count"] for r in by_word} == whole
    totals = {b: sum(k in t for k in KEYWORDS) for b, t in texts.items()}
    assert {r["book_id"]: r["total_keywords"] for r in kw.keyword_flags(books).collect()} == totals
    density = Counter(step(ladders.KEYWORD_DENSITY, n) for n in totals.values())
    got = cat.keyword_density().of(books).collect()
    assert {r["keyword_category"]: r["book_count"] for r in got} == density


def test_quartiles(books, records):
    pages = sorted(r["num_pages"] for r in records if (r["num_pages"] or 0) > 0)
    row = cat.page_summary().of(books).first()
    for share, label in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
        at_least = next(v for i, v in enumerate(pages, 1) if i >= share * len(pages))
        assert row[f"{label}_pages"] == at_least
    assert row["mean_pages"] == pytest.approx(sum(pages) / len(pages), abs=0.00501)


def test_key_uniqueness(books, records):
    doubled = books.unionByName(books.filter(F.col("book_id").cast("int") < 10))
    row = rp.key_uniqueness(doubled, "book_id").first()
    assert (row["total_rows"], row["distinct_keys"]) == (310, 300)
