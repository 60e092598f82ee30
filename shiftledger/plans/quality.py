"""Data quality marts over the staging view, duplicates included."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_reason, safe_divide
from ..schemas import METRIC_REASONS

SCOPE = ("run_id", "source_file")

# output counter -> reason flag of the catalogue
_COUNTERS = {
    "missing_id_field_rows": "missing_id_fields",
    "invalid_shift_rows": "invalid_shift",
    "missing_line_rows": "missing_line",
    "planned_output_missing_rows": "planned_output_missing",
    "planned_output_parse_failed_rows": "planned_output_parse_failed",
    "planned_output_invalid_rows": "planned_output_invalid",
    "actual_output_missing_rows": "actual_output_missing",
    "actual_output_parse_failed_rows": "actual_output_parse_failed",
    "actual_output_invalid_rows": "actual_output_invalid",
    "defect_qty_missing_rows": "defect_qty_missing",
    "defect_qty_parse_failed_rows": "defect_qty_parse_failed",
    "defect_qty_invalid_rows": "defect_qty_invalid",
    "defect_exceeds_actual_rows": "defect_exceeds_actual",
    "downtime_missing_rows": "downtime_missing",
    "downtime_parse_failed_rows": "downtime_parse_failed",
    "downtime_negative_rows": "downtime_negative",
    "downtime_over_480_rows": "downtime_over_480",
}
_PARSE_FLAGS = (
    "planned_output_parse_failed",
    "actual_output_parse_failed",
    "defect_qty_parse_failed",
    "downtime_parse_failed",
)


def reason_flags(
    staged: DataFrame,
    reason_catalog: Mapping[str, str] = METRIC_REASONS,
    scope: Sequence[str] = SCOPE,
) -> DataFrame:
    """Scope, validity columns and one boolean per catalogue entry (``r_<name>``)."""
    return staged.select(
        *scope,
        "ingested_at",
        "is_valid",
        "is_duplicate",
        *[
            has_reason(F.col("invalid_reason"), text).alias(f"r_{name}")
            for name, text in reason_catalog.items()
        ],
    )


def metric_counts(
    staged: DataFrame,
    reason_catalog: Mapping[str, str] = METRIC_REASONS,
    scope: Sequence[str] = SCOPE,
) -> DataFrame:
    """Counts per run and file, or another scope, one partial and one final aggregation.

    Counts of several sets of records add up to those of all, see ``add_metric_counts``.
    """

    def flag(name: str) -> Column:
        return F.col(f"r_{name}")

    duplicate = flag("duplicate") | F.col("is_duplicate").eqNullSafe(True)
    parse_error = flag(_PARSE_FLAGS[0])
    for name in _PARSE_FLAGS[1:]:
        parse_error = parse_error | flag(name)
    return (
        reason_flags(staged, reason_catalog, scope)
        .groupBy(*scope)
        .agg(
            F.min("ingested_at").alias("run_started_at"),
            F.max("ingested_at").alias("run_last_seen_at"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("is_valid").eqNullSafe(True)).alias("rows_valid"),
            F.count_if(F.col("is_valid").eqNullSafe(False)).alias("rows_invalid"),
            F.count_if(~flag("duplicate") & ~flag("missing_id_fields")).alias("unique_shift_logs"),
            *[F.count_if(flag(source)).alias(name) for name, source in _COUNTERS.items()],
            F.count_if(duplicate).alias("duplicate_rows"),
            F.count_if(parse_error).alias("parse_error_rows"),
        )
    )


def add_metric_counts(counts: DataFrame) -> DataFrame:
    """One row per run and file from the counts of several sets of their records."""
    added = ("total_rows", "rows_valid", "rows_invalid", "unique_shift_logs", *_COUNTERS, "duplicate_rows", "parse_error_rows")
    return counts.groupBy(*SCOPE).agg(
        F.min("run_started_at").alias("run_started_at"),
        F.max("run_last_seen_at").alias("run_last_seen_at"),
        *[F.sum(c).alias(c) for c in added],
    )


def metrics_of_counts(counts: DataFrame) -> DataFrame:
    """Counts and rates in the columns of the view."""

    def share(name: str, of: str) -> Column:
        return safe_divide(F.col(of), F.col("total_rows")).alias(name)

    return counts.select(
        *SCOPE,
        "run_started_at",
        "run_last_seen_at",
        "total_rows",
        "rows_valid",
        "rows_invalid",
        share("valid_rate", "rows_valid"),
        "unique_shift_logs",
        *_COUNTERS,
        "duplicate_rows",
        share("duplicate_rate", "duplicate_rows"),
        share("numeric_parse_error_rate", "parse_error_rows"),
    )


def dq_metrics_by_run(
    staged: DataFrame, reason_catalog: Mapping[str, str] = METRIC_REASONS
) -> DataFrame:
    """Counts and rates per run and file."""
    return metrics_of_counts(metric_counts(staged, reason_catalog))


def invalid_reason_counts(staged: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Rows per run, file and reason; a record counts once under each of its reasons."""
    return (
        staged.select(*scope, F.explode("invalid_reason").alias("reason"))
        .groupBy(*scope, "reason")
        .agg(F.count(F.lit(1)).alias("rows_count"))
        .withColumnRenamed("reason", "invalid_reason")
    )


def add_reason_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*SCOPE, "invalid_reason").agg(F.sum("rows_count").alias("rows_count"))


def most_frequent_first(counts: DataFrame) -> DataFrame:
    return counts.orderBy("run_id", F.desc("rows_count"))


def dq_invalid_reasons_by_run(staged: DataFrame) -> DataFrame:
    """Reason counts in the order of the view."""
    return most_frequent_first(invalid_reason_counts(staged))
