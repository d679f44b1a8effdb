"""All descriptive statistics of a catalogue, as CSV reports."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..checkpoints import materialise
from ..functions.text import KEYWORDS
from ..operators import catalogue as cat, keywords as kw, reports as rp, tags
from ..sources import files


def profile_reports() -> list[rp.Report]:
    """The reports over numbers and array sizes."""
    return [cat.series_split(), cat.series_distribution(), cat.rating_summary(), cat.rating_distribution(),
            cat.engagement_distribution(), cat.quality_vs_engagement(), cat.shelves_split(),
            cat.shelves_distribution(), cat.average_shelves(), cat.similar_split(), cat.average_similar(),
            cat.similar_distribution(), cat.page_distribution()]


def text_reports(keywords: Sequence[str]) -> list[rp.Report]:
    """The reports that read the descriptions, and the one with many averages.

    Counts, sums and deviations of either group stay below 100 fields (a mean takes
    two), the limit of whole-stage codegen.
    """
    return [cat.missing_values(), cat.similar_vs_performance(), kw.keyword_report(keywords=keywords),
            cat.keyword_density(keywords=keywords), cat.average_keywords(keywords=keywords)]


def quartile_reports() -> list[rp.Report]:
    """Kept apart: each needs another scan, for its quartiles."""
    return [cat.page_summary(), cat.engagement_summary()]


def run(spark: SparkSession, source: str, out: str, keywords: Sequence[str] = KEYWORDS) -> dict[str, DataFrame]:
    """Write every report under ``out``; returns the frames that were written.

    Four groups of reports take a scan each, of their own columns, plus one scan
    per exploded array and one for the key. A measured row is a few hundred numbers,
    materialised so that no report repeats the scan.
    """
    books = files.read_parquet(spark, source)
    reports: dict[str, DataFrame] = {"dataset_counts": materialise(rp.key_uniqueness(books, "book_id"))}
    for group in (profile_reports(), text_reports(keywords), quartile_reports()):
        measured = materialise(rp.measure(books, group))
        reports |= {report.title: report.read(measured) for report in group}

    frequency = reports["keyword_frequency"]
    reports |= {
        "keyword_frequency": kw.rank_keywords(frequency),
        "keyword_top_10": kw.rank_keywords(frequency, 10),
        "keyword_bottom_10": kw.rank_keywords(frequency, 10, least=True),
        "keyword_top_15": kw.rank_keywords(frequency, 15),
        "term_weights": kw.term_weights(frequency),
        "similar_trend": cat.similar_trend(reports["similar_vs_performance"]),
    }

    popularity = materialise(tags.tag_popularity(books))
    reports |= {"shelf_popularity": tags.by_popularity(popularity),
                "top_10_shelves": tags.by_popularity(popularity).limit(10),
                "most_used_shelves": tags.by_usage(popularity).limit(10),
                "most_referenced_books": materialise(tags.most_referenced(books))}

    for name, frame in reports.items():
        files.write_csv(frame, f"{out}/{name}")
    return reports
