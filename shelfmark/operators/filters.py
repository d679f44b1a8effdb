"""Row filters shared by the reports and the jobs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .joins import skew_join


def has_items(array: str | Column) -> Column:
    """True for a non-empty array; False (never NULL) for an empty or NULL one."""
    return F.coalesce(F.size(array) > 0, F.lit(False))


def has_text(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return column.isNotNull() & (column != "")


def has_items_sql(array: str) -> str:
    return f"coalesce(size({array}) > 0, false)"


def has_text_sql(text: str) -> str:
    return f"({text} IS NOT NULL AND {text} <> '')"


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def non_empty_array(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_items(column))


def non_empty_text(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_text(column))


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high``."""
    return df.filter(F.col(column).between(low, high))


def exclude_values(df: DataFrame, column: str, values: Sequence | DataFrame,
                   hot: dict | None = None) -> DataFrame:
    """Rows whose value is known and not in ``values``.

    A list becomes a literal set that is evaluated in the scan. A DataFrame with
    the same column becomes an anti join, for lists that do not fit in a plan;
    ``hot`` is as in ``skew_join``.
    """
    known = df.filter(F.col(column).isNotNull())
    if isinstance(values, DataFrame):
        return skew_join(known, values.select(column).distinct(), column, "left_anti", hot=hot)
    return known.filter(~F.col(column).isin(list(values)))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(0, subset=list(columns) if columns else None)
