"""Column contracts, fixed texts and fixed limits shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: input contract -------------------------------------------------
REQUIRED_COLUMNS = (
    "date",
    "shift",
    "line",
    "planned_output",
    "actual_output",
    "defect_qty",
    "downtime_min",
)
OPTIONAL_COLUMNS = ("downtime_reason", "operator", "source_system")
SOURCE_COLUMNS = REQUIRED_COLUMNS + OPTIONAL_COLUMNS

# --- fixed values: business limits ------------------------------------------------
SHIFTS = ("A", "B", "C")
SHIFT_MINUTES = 480

# --- fixed values: reasons emitted by record validation ---------------------------
DATE_MISSING = "date is missing"
DATE_PARSE_FAILED = "date parse failed"
PRODUCTION_DATE_INVALID = "production_date is invalid"
DUPLICATE_RECORD = "Duplicate record based on date, shift, and line"
PLANNED_OUTPUT_BAD = "planned_output is missing or 0 or less"
ACTUAL_OUTPUT_BAD = "actual_output is missing or less than 0"
DEFECT_QTY_BAD = "defect_qty is missing or less than 0"
DEFECT_OVER_ACTUAL = "defect_qty is greater than actual_output"
DOWNTIME_BAD = "downtime_min is missing or less than 0"
DOWNTIME_OVER_LIMIT = "downtime_min is over 480"
SHIFT_BAD = "shift is not A, B, or C"
LINE_MISSING = "line is missing"

# --- fixed values: reasons the quality metrics mart looks for ---------------------
# The mart counts literals of its own; only five of them are texts the validator
# emits, so the other counters stay 0 unless a caller passes another catalogue.
METRIC_REASONS = {
    "missing_id_fields": "date, shift, or line is missing for shift_log_id generation",
    "duplicate": DUPLICATE_RECORD,
    "planned_output_missing": "planned_output is missing",
    "planned_output_parse_failed": "planned_output is not a valid integer",
    "planned_output_invalid": "planned_output is 0 or less",
    "actual_output_missing": "actual_output is missing",
    "actual_output_parse_failed": "actual_output is not a valid integer",
    "actual_output_invalid": "actual_output is less than 0",
    "defect_qty_missing": "defect_qty is missing",
    "defect_qty_parse_failed": "defect_qty is not a valid integer",
    "defect_qty_invalid": "defect_qty is less than 0",
    "defect_exceeds_actual": DEFECT_OVER_ACTUAL,
    "downtime_missing": "downtime_min is missing",
    "downtime_parse_failed": "downtime_min is not a valid integer",
    "downtime_negative": "downtime_min is less than 0",
    "downtime_over_480": DOWNTIME_OVER_LIMIT,
    "invalid_shift": SHIFT_BAD,
    "missing_line": LINE_MISSING,
}


def _string(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable)


_METADATA_FIELDS = [
    _string("source_file", False),
    T.StructField("row_number", T.LongType(), False),
    _string("row_id", False),
    T.StructField("ingested_at", T.TimestampType(), False),
    _string("run_id", False),
]
METADATA_COLUMNS = tuple(f.name for f in _METADATA_FIELDS)

RAW_SCHEMA = T.StructType([_string(c) for c in SOURCE_COLUMNS] + _METADATA_FIELDS)

VALIDATED_SCHEMA = T.StructType(
    [
        _string("date"),
        T.StructField("production_date", T.DateType()),
        _string("shift"),
        _string("shift_normalized"),
        _string("line"),
        _string("line_normalized"),
        _string("planned_output"),
        T.StructField("planned_output_int", T.LongType()),
        _string("actual_output"),
        T.StructField("actual_output_int", T.LongType()),
        _string("defect_qty"),
        T.StructField("defect_qty_int", T.LongType()),
        _string("downtime_min"),
        T.StructField("downtime_min_int", T.LongType()),
        _string("downtime_reason"),
        _string("operator"),
        _string("source_system"),
        *_METADATA_FIELDS,
        T.StructField("is_valid", T.BooleanType(), False),
        T.StructField("invalid_reason", T.ArrayType(T.StringType(), False)),
        T.StructField("is_duplicate", T.BooleanType(), False),
        _string("shift_log_id"),
    ]
)

KPI_SCHEMA = T.StructType(
    [
        _string("shift_log_id", False),
        _string("date", False),
        _string("shift", False),
        _string("line", False),
        T.StructField("planned_output", T.LongType(), False),
        T.StructField("actual_output", T.LongType(), False),
        T.StructField("defect_qty", T.LongType(), False),
        T.StructField("downtime_min", T.LongType(), False),
        _string("downtime_reason"),
        T.StructField("production_achievement", T.DoubleType()),
        T.StructField("defect_rate", T.DoubleType()),
        T.StructField("downtime_rate", T.DoubleType()),
        _string("operator"),
        _string("source_system"),
        _string("source_file"),
        T.StructField("row_number", T.LongType()),
        _string("row_id"),
        T.StructField("ingested_at", T.TimestampType()),
        _string("run_id"),
    ]
)


def required_of(schema: T.StructType) -> list[str]:
    """Columns a table of this schema must never hold NULL in."""
    return [f.name for f in schema.fields if not f.nullable]
