"""Integer parsing and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, ascii_digits

# fixed value: optional sign, digits, single underscores between digits, white space around
_BLANKS = f"[{WHITESPACE_CLASS}]*"
INTEGER_TEXT = rf"\A{_BLANKS}([+-]?[0-9]+(?:_[0-9]+)*){_BLANKS}\z"


def parse_int(text: Column) -> Column:
    """64-bit integer of a text, NULL where it is blank, malformed or out of range.

    The pattern yields an empty text where it does not match, which casts to NULL. A bare cast
    would also take texts with control characters and refuse the underscores.
    """
    digits = F.regexp_extract(ascii_digits(text), INTEGER_TEXT, 1)
    return F.replace(digits, F.lit("_"), F.lit("")).try_cast("bigint")


def safe_divide(dividend: Column, divisor: Column) -> Column:
    """Double quotient, NULL where the divisor is 0 or NULL."""
    return F.try_divide(dividend.cast("double"), divisor.cast("double"))


def divide_or_zero(dividend: Column, divisor: Column) -> Column:
    """Double quotient with 0 instead of an undefined result."""
    return F.coalesce(safe_divide(dividend, divisor), F.lit(0.0))
