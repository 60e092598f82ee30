"""CSV text as a machine of states, in expressions over pieces of a file.

A reader of CSV text is at the start of a field, in a bare field, in a quoted one, behind a quote seen in a
quoted one, or behind a carriage return. Files are read in pieces that end at one kind of line break, and a
line break outside quotes ends the field and the record whatever came before it. So where a piece begins
only two of the five states are left: at the start of a record, or in a quoted field. A piece is a map of
these two states, and maps are composed over pieces and over blocks of pieces; what happens inside a
piece, with all five states, is said by the patterns below. Text begun in a quoted field reads like the
same text behind a quote, so one pattern serves both states.

* A quote opens a field only as its first sign; in a bare field it is a sign like others.
* Two quotes in a quoted field are one; text behind the closing quote belongs to the field.
* CR, LF and CR LF outside quotes end a record, inside quotes they are kept. Records without any
  sign are skipped, so CR LF may as well count as two breaks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"[^,\r\n]*+|[^",\r\n][^,\r\n]*+|)'
#: Text that leaves a quoted field open.
OPENS = rf'\A(?:{_FIELD}[,\r\n])*+"{_QUOTED}\z'
#: A record, or the open end of the text, and the break behind it.
RECORD = rf'((?:{_FIELD},)*+(?:"{_QUOTED}\z|{_FIELD}))(?:[\r\n]|\z)'
_NEXT_FIELD = rf",({_FIELD})"


def is_blank(piece: Column) -> Column:
    return piece.isin("", "\r")


def has_break(piece: Column) -> Column:
    """A line break inside the piece; a last CR is half of a CR LF."""
    cr = F.instr(piece, "\r")
    return F.contains(piece, F.lit("\n")) | ((cr > 0) & (cr < F.char_length(piece)))


def is_simple(piece: Column) -> Column:
    """One record or none from the start of a record, and all inside from within quotes."""
    return ~F.contains(piece, F.lit('"')) & ~has_break(piece)


def opens(piece: Column) -> Column:
    """Whether a piece that begins a record ends in a quoted field."""
    return F.contains(piece, F.lit('"')) & piece.rlike(OPENS)


def _quoted(piece: Column) -> Column:
    return F.concat(F.lit('"'), piece)


def stays(piece: Column) -> Column:
    """Whether a piece that begins in a quoted field ends in one."""
    return is_simple(piece) | _quoted(piece).rlike(OPENS)


def without_cr(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.char_length(text) - 1)).otherwise(text)


def records_of(piece: Column, inside: Column) -> Column:
    """Records of a piece, blank ones left out.

    Begun inside quotes, the first one is the rest of an earlier record behind a quote of ours.
    """
    text = F.when(inside, _quoted(piece)).otherwise(piece)
    cut = F.array_remove(F.regexp_extract_all(text, F.lit(RECORD), F.lit(1)), "")
    plain = F.array_remove(F.array(without_cr(piece)), "")
    return F.when(is_simple(piece), F.when(inside, F.array(text)).otherwise(plain)).otherwise(cut)


def fields_of(record: Column) -> Column:
    """Texts of a whole record's fields; an empty field is an empty text."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_NEXT_FIELD), F.lit(1))

    def text(field: Column) -> Column:
        inner = F.regexp_extract(field, rf'\A"({_QUOTED})"', 1)
        behind = F.substring(field, F.char_length(inner) + 3, F.char_length(field))
        return F.when(
            F.startswith(field, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), behind)
        ).otherwise(field)

    return F.when(F.contains(record, F.lit('"')), F.transform(quoted, text)).otherwise(F.split(record, ","))
