"""Keyword analytics over free text: one scan, however many keywords."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import percent_sql
from ..functions.text import KEYWORDS, mentions, quoted
from .filters import has_text, has_text_sql
from .reports import Report, name


def keyword_report(text: str = "description", keywords: Sequence[str] = KEYWORDS,
                   match: str = "substring") -> Report:
    """Per keyword, the number and percentage of non-empty texts containing it.

    A keyword that never occurs has a zero row. Without any text the percentage is 0.
    """
    def measures(m):
        counts = {f"k{i}": f"count_if({mentions(m('text'), k, match)})" for i, k in enumerate(keywords)}
        return {**counts, "total": f"count({m('text')})"}

    def rows(m):
        return [{"keyword": quoted(k), "book_count": m(f"k{i}"),
                 "percentage": f"coalesce({percent_sql(m(f'k{i}'), m('total'))}, 0.0D)"}
                for i, k in enumerate(keywords)]

    lowered = f"CASE WHEN {has_text_sql(name(text))} THEN lower({name(text)}) END"
    return Report("keyword_frequency", {"text": lowered}, measures, rows)


def rank_keywords(counts: DataFrame, k: int | None = None, least: bool = False) -> DataFrame:
    """Keywords by count, most (or least) common first, ties by keyword."""
    order = F.asc("book_count") if least else F.desc("book_count")
    ranked = counts.orderBy(order, "keyword")
    return ranked if k is None else ranked.limit(k)


def keyword_frequency(df: DataFrame, text: str = "description", keywords: Sequence[str] = KEYWORDS,
                      match: str = "substring") -> DataFrame:
    return rank_keywords(keyword_report(text, keywords, match).of(df))


def term_weights(counts: DataFrame) -> DataFrame:
    """The frequency table as (term, weight), the input of a word cloud."""
    return counts.selectExpr("keyword AS term", "book_count AS weight")


def keyword_flags(df: DataFrame, key: str = "book_id", text: str = "description",
                  keywords: Sequence[str] = KEYWORDS, match: str = "substring") -> DataFrame:
    """A ``has_<keyword>`` 0/1 column per keyword and ``total_keywords``, per non-empty text."""
    names = [name(f"has_{k}") for k in keywords]
    return (df.filter(has_text(text))
              .selectExpr(name(key), f"lower({name(text)}) AS _text")
              .selectExpr(name(key), *[f"int({mentions('_text', k, match)}) AS {n}" for k, n in zip(keywords, names)])
              .selectExpr("*", f"{' + '.join(['0', *names])} AS total_keywords"))
