"""Normalised key fields and typed quantities beside the untouched raw values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize_date, normalize_line, normalize_shift, parse_int

QUANTITIES = ("planned_output", "actual_output", "defect_qty", "downtime_min")


def normalize_records(raw: DataFrame) -> DataFrame:
    """One narrow projection; nothing is shuffled and no raw value changes."""
    return raw.withColumns(
        {
            "production_date": normalize_date(F.col("date")),
            "shift_normalized": normalize_shift(F.col("shift")),
            "line_normalized": normalize_line(F.col("line")),
            **{f"{name}_int": parse_int(F.col(name)) for name in QUANTITIES},
        }
    )
