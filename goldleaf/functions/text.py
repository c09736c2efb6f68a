"""Text columns built from native Spark functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


SPACE = " \t\n\x0b\f\r"


def strip_chars(text: Column, chars: str) -> Column:
    """Drop any of the characters at both ends, in one linear pass."""
    return F.btrim(text, F.lit(chars))


def strip_space(text: Column) -> Column:
    """Drop blanks, tabs and line breaks at both ends (plain trim drops blanks only)."""
    return strip_chars(text, SPACE)


def blank_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def normal_key(text: Column) -> Column:
    """Lookup form of a name: stripped and lowered, NULL as empty text."""
    return F.lower(strip_space(blank_to_empty(text)))


def contains_any(text: Column, phrases: list[str]) -> Column:
    """True if any phrase occurs in the text (plain substring, not whole words)."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def long_words(text: Column, longer_than: int) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: F.length(w) > longer_than)


def first_json_object(text: Column) -> Column:
    """From the first opening to the last closing brace; NULL if there is none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)
