"""Rounding and ratios with one rule everywhere, as columns and as SQL text."""

from pyspark.sql import Column, functions as F


def rounded(value: Column, places: int = 2) -> Column:
    """Half-up rounding on the decimal value, back as a double.

    Going through a decimal makes ties such as 20.005 round the same way on
    every engine; rounding the binary double does not.
    """
    return F.round(value.cast("decimal(38,6)"), places).cast("double")


def rounded_sql(value: str, places: int = 2) -> str:
    return f"double(round(cast({value} AS decimal(38,6)), {places}))"


def percent_sql(part: str, whole: str, places: int = 2) -> str:
    """``part`` in percent of ``whole``; NULL when ``whole`` is 0."""
    return rounded_sql(f"try_divide(({part}) * 100.0D, {whole})", places)
