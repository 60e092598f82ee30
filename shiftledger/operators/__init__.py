"""Record-level and set-level operators, ``DataFrame`` in and ``DataFrame`` out."""

from .dedup import dedup_latest, validated_dedup
from .duplicates import flag_duplicates
from .normalize import normalize_records
from .rules import RULES
from .validate import add_shift_log_id, split_by_validity, validate, validate_records

__all__ = [
    "RULES",
    "add_shift_log_id",
    "dedup_latest",
    "flag_duplicates",
    "normalize_records",
    "split_by_validity",
    "validate",
    "validate_records",
    "validated_dedup",
]
