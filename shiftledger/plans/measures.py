"""Report measures and report filters over KPI rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import divide_or_zero, safe_divide


def report_measures(kpi: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals and divide-or-zero rates, overall or per group."""
    planned, actual = F.sum("planned_output"), F.sum("actual_output")
    return kpi.groupBy(*by).agg(
        planned.alias("total_planned_output"),
        actual.alias("total_actual_output"),
        divide_or_zero(actual, planned).alias("achievement_rate"),
        divide_or_zero(F.sum("defect_qty"), actual).alias("defect_rate"),
        divide_or_zero(actual - planned, planned).alias("output_variance_pct"),
        safe_divide(F.sum("downtime_min"), F.lit(60)).alias("total_downtime_hours"),
    )


def output_variance_by_line(kpi: DataFrame) -> DataFrame:
    return report_measures(kpi, ["line"]).select("line", "output_variance_pct")


def defect_rate_by_line(kpi: DataFrame) -> DataFrame:
    return report_measures(kpi, ["line"]).select("line", "defect_rate")


def planned_vs_actual_daily(kpi: DataFrame) -> DataFrame:
    return report_measures(kpi, ["date"]).select(
        "date", "total_planned_output", "total_actual_output"
    )


def downtime_by_reason(kpi: DataFrame) -> DataFrame:
    return kpi.groupBy("downtime_reason").agg(F.sum("downtime_min").alias("downtime_min"))


def report_filter(
    df: DataFrame,
    run_ids: Sequence[str] | None = None,
    source_files: Sequence[str] | None = None,
    dates: tuple[str, str] | None = None,
    lines: Sequence[str] | None = None,
    shifts: Sequence[str] | None = None,
    date_col: Column | None = None,
) -> DataFrame:
    """Report slicers; plain predicates, so they push down to a stored mart.

    ``dates`` is a range of the raw date texts; with ``date_col``, such as
    ``normalize_date(F.col("date"))``, it is one of true dates. A table stored by month then opens
    the partitions of these months only; their column is not part of the result.
    """
    wanted = {"run_id": run_ids, "source_file": source_files, "line": lines, "shift": shifts}
    for name, values in wanted.items():
        if values is not None:
            df = df.where(F.col(name).isin(*values))
    if dates is not None:
        if date_col is None:
            df = df.where(F.col("date").between(*dates))
        else:
            df = df.where(date_col.between(*[F.lit(d).cast("date") for d in dates]))
            if "month" in df.columns:
                df = df.where(F.col("month").between(dates[0][:7], dates[1][:7]))
    return df.drop("month")
