"""Staging view over the validated table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_shift_logs(validated: DataFrame, *more: str) -> DataFrame:
    """Normalised and typed columns under plain names; ``date`` stays the raw text.

    ``more`` columns of the stored table, such as those of its partitions, come behind.
    """
    renamed = {
        "shift_normalized": "shift",
        "line_normalized": "line",
        "planned_output_int": "planned_output",
        "actual_output_int": "actual_output",
        "defect_qty_int": "defect_qty",
        "downtime_min_int": "downtime_min",
    }
    return validated.select(
        "row_id",
        "shift_log_id",
        "date",
        *[F.col(source).alias(name) for source, name in renamed.items()],
        "downtime_reason",
        "operator",
        "source_system",
        "is_valid",
        "invalid_reason",
        "is_duplicate",
        "ingested_at",
        "source_file",
        "row_number",
        "run_id",
        *more,
    )
