"""Strict JSON documents, entirely in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT = "map<string,variant>"


def as_text(value: Column) -> Column:
    """Bytes as text, NULL unless they are valid UTF-8."""
    text = value.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def json_values(text: Column) -> Column:
    """The values of the JSON array ``[text]``, NULL if that does not parse."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast("array<variant>")


def is_document(text: Column, values: Column) -> Column:
    """True iff ``text`` is exactly one JSON object; ``values`` are its ``json_values``.

    The parser ignores what follows a complete value, so the text was wrapped:
    in ``[text]`` a trailing text breaks the array or makes it longer, unless the
    text closes the array itself with a bracket after the object. Only a text
    with ``}`` before ``]`` can do that; it is also tried as ``{"v":text}``,
    which such a bracket breaks.
    """
    alone = (F.size(values) == 1) & F.get(values, 0).try_cast(_OBJECT).isNotNull()
    fields = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).try_cast(_OBJECT)
    closed = ~text.rlike(r"\}\s*\]") | (F.size(F.map_keys(fields)) == 1)
    return F.coalesce(alone & closed, F.lit(False))


# What the JSON parser takes at most. Characters of a string and of a key,
# digits of a number, levels of nesting.
_STRING, _KEY, _DIGITS, _LEVELS = 20_000_000, 50_000, 1_000, 1_000


def over_parser_limits(text: Column) -> Column:
    """True if a text that did not parse may only have met a limit of the parser."""
    digits = text.rlike(rf"[0-9.]{{{_DIGITS}}}")
    key = text.rlike(rf'"[^"]{{{_KEY}}}')
    opened = F.length(F.regexp_replace(text, r"[^\[{]", ""))
    return (F.length(text) > _STRING) | digits | key | (opened >= _LEVELS)


def flat_document(text: Column, position: Column) -> Column:
    """The text of a JSON object with a struct as its first field ``_position``.

    The object's own fields stay at the top, as they are written. Line breaks outside
    of strings, where alone they can stand, become blanks, so it is one line.
    """
    inner = F.regexp_replace(F.regexp_replace(text, r"^\s*\{\s*", ""), r"[\r\n]", " ")
    comma = F.when(inner.rlike(r"^\}"), "").otherwise(",")
    return F.concat(F.lit('{"_position":'), F.to_json(position), comma, inner)


def header_text(headers: Column, name: str) -> Column:
    """The last message header of that name as text."""
    named = F.filter(headers, lambda header: header["key"] == name)
    return F.get(named, F.size(named) - 1)["value"].cast("string")
