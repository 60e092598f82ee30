"""Small hand-made records for the tests."""

from datetime import datetime, timezone

from shiftledger.operators import validate_records
from shiftledger.plans.staging import stg_shift_logs
from shiftledger.schemas import RAW_SCHEMA

NAMESPACE = "3d1c5a60-2f0b-4c7e-9a51-6b8e0f4d2c17"
DAY = datetime(2026, 1, 5, tzinfo=timezone.utc)

_USUAL = {
    "date": "2026-01-05",
    "shift": "A",
    "line": "Saw 1",
    "planned_output": "640",
    "actual_output": "608",
    "defect_qty": "7",
    "downtime_min": "24",
    "downtime_reason": "Blade change",
    "operator": "Okafor",
    "source_system": "Tablet",
    "source_file": "mill.csv",
    "ingested_at": DAY,
    "run_id": "run-1",
}


def raw_logs(spark, *changes):
    """One raw record per dict of changes; rows are numbered in order."""
    rows = []
    for number, change in enumerate(changes, start=1):
        record = {**_USUAL, "row_number": number, "row_id": f"id-{number:04d}", **change}
        rows.append(tuple(record[name] for name in RAW_SCHEMA.names))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def validated_logs(spark, *changes, **options):
    return validate_records(raw_logs(spark, *changes), NAMESPACE, **options)


def staged_logs(spark, *changes):
    return stg_shift_logs(validated_logs(spark, *changes))


def by_row(df, *columns):
    """Column values in row order."""
    return [tuple(r) for r in df.orderBy("row_number").select(*columns).collect()]
