"""Text that may be dirty: whatever does not parse becomes NULL, also under ANSI SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_number(text: Column | str) -> Column:
    """The first run of digits as INT; NULL without digits or beyond INT."""
    return F.regexp_extract(_column(text), r"\d+", 0).try_cast("int")


def text_year(text: Column | str) -> Column:
    """Characters 7 to 10, the year of a ``dd-MM-yyyy...`` text, as text."""
    return F.substring(_column(text), 7, 4)


def parsed_date(text: Column | str, pattern: str) -> Column:
    return F.try_to_date(_column(text), pattern)


def in_words(text: Column | str, words: Iterable[str]) -> Column:
    """1 if the text is one of ``words``, whatever its case, else 0 (also for NULL)."""
    return F.when(F.lower(_column(text)).isin([word.lower() for word in words]), 1).otherwise(0)
