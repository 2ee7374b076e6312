"""Filters on text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import first_number, parsed_date


def size_at_least(df: DataFrame, text: str, least: int) -> DataFrame:
    """Rows whose first number in ``text`` is at least ``least``; no number, no row."""
    return df.filter(first_number(text) >= least)


def size_in_form(
    df: DataFrame, text: str, forms: list[tuple[Column, int]]
) -> DataFrame:
    """Rows that have one of several forms and reach that form's least number."""
    size = first_number(text)
    wanted = F.lit(False)
    for form, least in forms:
        wanted = wanted | (form & (size >= least))
    return df.filter(wanted)


def flagged_detail(
    df: DataFrame,
    flag: str,
    date_text: str,
    year: int,
    equal: dict[str, str],
    pattern: str = "d/M/yyyy",
) -> DataFrame:
    """Flagged rows of one year that equal all given texts, the date as ``yyyy-MM-dd``."""
    day = parsed_date(date_text, pattern)
    kept = df.filter((F.year(day) == year) & (F.col(flag) == 1))
    for column, text in equal.items():
        kept = kept.filter(F.col(column) == text)
    return kept.withColumn(date_text, F.date_format(day, "yyyy-MM-dd"))
