"""Whitespace and label normalisation.

All functions here and in the sibling modules mention their input once. Spark copies an
expression into every place that uses it when it merges projections or pushes a filter down,
so an input mentioned five times on three levels would grow the plan a hundredfold.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the Unicode white space characters, as ranges of code points
WHITESPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(p) for low, high in WHITESPACE_RANGES for p in range(low, high + 1))
# inside a regular expression character class
WHITESPACE_CLASS = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in WHITESPACE_RANGES)
_NOT_BLANK = f"[^{WHITESPACE_CLASS}]"


def strip(text: Column) -> Column:
    """Remove Unicode white space on both sides; plain ``trim`` knows only the space."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_to_null(text: Column) -> Column:
    """Stripped text, NULL where nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def is_blank(text: Column) -> Column:
    """True for NULL and for a text of white space only; stops at the first other character."""
    return ~F.coalesce(text.rlike(_NOT_BLANK), F.lit(False))


def normalize_shift(text: Column) -> Column:
    return F.upper(strip_to_null(text))


def normalize_line(text: Column) -> Column:
    return strip_to_null(text)


# decimal digits of all scripts but ASCII, by the rule that each script has ten in a row
_DIGITS = [chr(c) for c in range(128, 0x110000) if unicodedata.decimal(chr(c), None) is not None]
_ASCII = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as ASCII ones; texts without such digits stay as they are."""
    return F.translate(text, "".join(_DIGITS), _ASCII)
