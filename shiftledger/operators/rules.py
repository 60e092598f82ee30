"""Validation rules: one condition per reason text.

Every rule is a function without arguments returning the condition under which a normalised
record gets the reason. A condition may be NULL, which counts as "not found".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import is_blank


def _absent_or_below(name: str, least: int) -> Column:
    return F.coalesce(F.col(name), F.lit(least - 1)) < least


def date_missing() -> Column:
    return is_blank(F.col("date"))


def date_parse_failed() -> Column:
    return ~is_blank(F.col("date")) & F.col("production_date").isNull()


def production_date_invalid() -> Column:
    """Only a text column can hold a malformed date; ``validate`` skips it for a ``DATE``."""
    text = F.col("production_date")
    return text.isNotNull() & ~F.coalesce(
        text.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z") & text.try_cast("date").isNotNull(),
        F.lit(False),
    )


def duplicate_record() -> Column:
    return F.col("is_duplicate")


def planned_output_bad() -> Column:
    return _absent_or_below("planned_output_int", 1)


def actual_output_bad() -> Column:
    return _absent_or_below("actual_output_int", 0)


def defect_qty_bad() -> Column:
    return _absent_or_below("defect_qty_int", 0)


def defect_over_actual() -> Column:
    return F.col("defect_qty_int") > F.col("actual_output_int")


def downtime_bad() -> Column:
    return _absent_or_below("downtime_min_int", 0)


def downtime_over_limit() -> Column:
    return F.col("downtime_min_int") > S.SHIFT_MINUTES


def shift_bad() -> Column:
    return ~F.coalesce(F.col("shift_normalized"), F.lit("")).isin(*S.SHIFTS)


def line_missing() -> Column:
    return F.coalesce(F.col("line_normalized"), F.lit("")) == ""


RULES = {
    S.DATE_MISSING: date_missing,
    S.DATE_PARSE_FAILED: date_parse_failed,
    S.PRODUCTION_DATE_INVALID: production_date_invalid,
    S.DUPLICATE_RECORD: duplicate_record,
    S.PLANNED_OUTPUT_BAD: planned_output_bad,
    S.ACTUAL_OUTPUT_BAD: actual_output_bad,
    S.DEFECT_QTY_BAD: defect_qty_bad,
    S.DEFECT_OVER_ACTUAL: defect_over_actual,
    S.DOWNTIME_BAD: downtime_bad,
    S.DOWNTIME_OVER_LIMIT: downtime_over_limit,
    S.SHIFT_BAD: shift_bad,
    S.LINE_MISSING: line_missing,
}
