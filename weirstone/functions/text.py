"""Text helpers: keys, blanks, strict integers, array repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(gtc_number: Column, order_number: Column) -> Column:
    """For example gtc1234-0001; a longer number is kept whole."""
    return F.format_string("%s-%04d", gtc_number, order_number)


def is_blank(text: Column) -> Column:
    """NULL, empty or white space only."""
    return text.isNull() | ~F.coalesce(text, F.lit("")).rlike(r"\S")


def part(text: Column, separator: str, number: int) -> Column:
    """1-based part of the text split at the first separator; the second part keeps the rest."""
    return F.get(F.split(text, _literal(separator), 2), F.lit(number - 1))


def strict_integer(value: Column) -> Column:
    """Whole numbers only: NULL for blank text and for text that is not an integer."""
    return F.trim(value.cast("string")).try_cast("bigint")


def is_bad_integer(value: Column) -> Column:
    """True where text is present but is no integer; such cells are counted, not fatal."""
    text = value.cast("string")
    return ~is_blank(text) & strict_integer(text).isNull()


def pg_array_to_array(text: Column) -> Column:
    """``{a,"b,c",NULL}`` to an array of strings; ``{}`` to an empty array.

    Elements may be quoted, with backslash escapes; an unquoted NULL is a NULL element.
    """
    body = F.regexp_extract(F.trim(text), r"(?s)^\{(.*)\}$", 1)
    raw = F.regexp_extract_all(body, F.lit(r'(?s)("(?:[^"\\]|\\.)*"|[^,"]+)'), F.lit(1))
    elements = F.transform(
        raw,
        lambda e: F.when(
            e.startswith('"'),
            F.regexp_replace(F.substring(e, F.lit(2), F.length(e) - 2), r"(?s)\\(.)", "$1"),
        ).when(F.upper(F.trim(e)) != "NULL", F.trim(e)),
    )
    return F.when(F.trim(text).rlike(r"(?s)^\{.*\}$"), elements)


def _literal(separator: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() else c for c in separator)
