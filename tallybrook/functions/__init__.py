"""Column functions."""

from tallybrook.functions.documents import (
    as_text,
    flat_document,
    header_text,
    is_document,
    json_values,
    over_parser_limits,
)
from tallybrook.functions.sums import Addend, Span, exact_mean, exact_sum, is_floating, spans
from tallybrook.functions.text import first_number, in_words, parsed_date, text_year

__all__ = [
    "Addend",
    "Span",
    "as_text",
    "exact_mean",
    "exact_sum",
    "flat_document",
    "first_number",
    "header_text",
    "in_words",
    "is_document",
    "is_floating",
    "json_values",
    "over_parser_limits",
    "parsed_date",
    "spans",
    "text_year",
]
