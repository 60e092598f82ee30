"""Scalar functions, ``Column`` in and ``Column`` out, all evaluated inside the JVM."""

from .dates import normalize_date
from .keys import shift_log_id, uuid_v5
from .numbers import divide_or_zero, parse_int, safe_divide
from .reasons import assemble_reasons, has_reason
from .text import normalize_line, normalize_shift, strip

__all__ = [
    "assemble_reasons",
    "divide_or_zero",
    "has_reason",
    "normalize_date",
    "normalize_line",
    "normalize_shift",
    "parse_int",
    "safe_divide",
    "shift_log_id",
    "strip",
    "uuid_v5",
]
