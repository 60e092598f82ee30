"""Production date normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, ascii_digits

# fixed values: year first or day first, one separator throughout, four-digit year from
# 0001, month and day with one or two digits; after a year a one-digit day may be padded by
# a blank
_YEAR = r"((?!0000)[0-9]{4})"
_MONTH = r"(1[0-2]|0?[1-9])"
_DAY = r"(3[01]|[12][0-9]|0?[1-9])"
_PADDED_DAY = r"(?:(3[01]|[12][0-9]|0?[1-9])| ([1-9]))"
_YEAR_FIRST = rf"{_YEAR}([-/.]){_MONTH}\2{_PADDED_DAY}"
_DAY_FIRST = rf"{_DAY}([-/.]){_MONTH}\7{_YEAR}"
_BLANKS = f"[{WHITESPACE_CLASS}]*"
# the last alternative takes any other text, for which all groups stay empty
DATE_TEXT = rf"(?s)\A(?:{_BLANKS}(?:{_YEAR_FIRST}|{_DAY_FIRST}){_BLANKS}|.*)\z"
_ISO = "$1$9-$3$8-$4$5$6"


def normalize_date(text: Column) -> Column:
    """Date of a year-first or day-first text, NULL for anything else.

    One pattern settles the shape and turns the parts round, the cast settles the calendar
    (30 February is NULL). Other texts become ``--``, which is no date. ``try_to_date`` is not
    used because its patterns take wider fields.
    """
    return F.regexp_replace(ascii_digits(text), DATE_TEXT, _ISO).try_cast("date")
