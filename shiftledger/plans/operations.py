"""KPI rows and the operations marts built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_divide
from ..operators.dedup import validated_dedup
from ..operators.running import running_total
from ..schemas import SHIFT_MINUTES
from ..session import stage

# The Pareto shares run over one row per distinct reason. Up to this many reasons (some ten
# megabytes) one task computes them; beyond it the distributed running total does.
PARETO_SINGLE_TASK_REASONS = 100_000

SUMS = ("planned_output", "actual_output", "defect_qty", "downtime_min")
_SUMMARY_NAMES = (
    "total_planned_output",
    "total_actual_output",
    "total_defects",
    "total_downtime_min",
)


def shift_log_kpi(dedup: DataFrame, *more: str) -> DataFrame:
    """Valid rows of a deduplicated view with the three ratios, and ``more`` of its columns.

    Validity is tested after deduplication on purpose: where the latest record of a key is
    invalid, that key has no KPI row.
    """
    return dedup.where(F.col("is_valid").eqNullSafe(True)).select(
        "shift_log_id",
        "date",
        "shift",
        "line",
        "planned_output",
        "actual_output",
        "defect_qty",
        "downtime_min",
        "downtime_reason",
        "operator",
        "source_system",
        "source_file",
        "row_number",
        "row_id",
        "run_id",
        "ingested_at",
        safe_divide(F.col("actual_output"), F.col("planned_output")).alias("production_achievement"),
        safe_divide(F.col("defect_qty"), F.col("actual_output")).alias("defect_rate"),
        safe_divide(F.col("downtime_min"), F.lit(SHIFT_MINUTES)).alias("downtime_rate"),
        *more,
    )


def kpi_of_staged(staged: DataFrame) -> DataFrame:
    """KPI rows straight from staging, those of records without a key included.

    Under the standard rules a missing key always comes with a date, shift or line reason, so
    none of those records is valid, and their scan is filtered down to nearly nothing. Own rules
    may hold them valid.
    """
    return shift_log_kpi(validated_dedup(staged))


def kpi_without_dedup(validated: DataFrame) -> DataFrame:
    """Valid records of a batch with the ratios, validation columns dropped."""
    return (
        validated.where(F.col("is_valid"))
        .drop("date_iso", "is_duplicate", "invalid_reason", "is_valid")
        .withColumns(
            {
                "production_achievement": safe_divide(
                    F.col("actual_output_int"), F.col("planned_output_int")
                ),
                "defect_rate": safe_divide(F.col("defect_qty_int"), F.col("actual_output_int")),
                "downtime_rate": safe_divide(F.col("downtime_min_int"), F.lit(SHIFT_MINUTES)),
            }
        )
    )


def kpi_drilldown(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "date",
        "shift",
        "line",
        "planned_output",
        "actual_output",
        "defect_qty",
        "downtime_min",
        "downtime_reason",
        "production_achievement",
        "defect_rate",
        "downtime_rate",
        "operator",
        "source_system",
        "source_file",
        "row_number",
        "row_id",
        "run_id",
        "ingested_at",
    )


def _ratios_of_sums(count: str, planned: str, actual: str, defects: str, downtime: str) -> dict:
    return {
        "production_achievement": safe_divide(F.col(actual), F.col(planned)),
        "defect_rate": safe_divide(F.col(defects), F.col(actual)),
        "downtime_rate": safe_divide(F.col(downtime), F.col(count) * SHIFT_MINUTES),
    }


def kpi_by(kpi: DataFrame, *by: str) -> DataFrame:
    """Sums per group and ratios of those sums, never means of row ratios."""
    return (
        kpi.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("shift_count"), *[F.sum(c).alias(c) for c in SUMS])
        .withColumns(_ratios_of_sums("shift_count", *SUMS))
    )


def kpi_by_line(kpi: DataFrame) -> DataFrame:
    return kpi_by(kpi, "line")


def kpi_by_shift(kpi: DataFrame) -> DataFrame:
    return kpi_by(kpi, "shift")


def kpi_daily_trend(kpi: DataFrame, date_col: str = "date") -> DataFrame:
    """Grouped by the raw date text, so two spellings of one day are two rows."""
    return kpi_by(kpi, date_col)


def line_shift_performance(kpi: DataFrame) -> DataFrame:
    return kpi_by(kpi, "line", "shift")


def kpi_summary(kpi: DataFrame) -> DataFrame:
    """One row always; without any KPI row the count is 0 and everything else NULL."""
    return kpi.agg(
        F.count(F.lit(1)).alias("kpi_records"),
        *[F.sum(source).alias(name) for source, name in zip(SUMS, _SUMMARY_NAMES)],
    ).withColumns(_ratios_of_sums("kpi_records", *_SUMMARY_NAMES))


PARTIAL_KEYS = ("date", "line", "shift", "downtime_reason")


def kpi_partials(kpi: DataFrame, *by: str) -> DataFrame:
    """Sums of KPI rows in the finest grouping of any view, within ``by``; all views follow from them."""
    return kpi.groupBy(*by, *PARTIAL_KEYS).agg(
        F.count(F.lit(1)).alias("shift_count"), *[F.sum(c).alias(c) for c in SUMS]
    )


def partials_by(partials: DataFrame, *by: str) -> DataFrame:
    """A view from partial sums, equal to ``kpi_by`` or, without keys, to ``kpi_summary`` of the rows."""
    sums = [F.sum(c).alias(c) for c in SUMS]
    if by:
        added = partials.groupBy(*by).agg(F.sum("shift_count").alias("shift_count"), *sums)
        return added.withColumns(_ratios_of_sums("shift_count", *SUMS))
    names = dict(zip(SUMS, _SUMMARY_NAMES))
    return partials.agg(
        F.coalesce(F.sum("shift_count"), F.lit(0)).alias("kpi_records"),
        *[F.sum(source).alias(name) for source, name in names.items()],
    ).withColumns(_ratios_of_sums("kpi_records", *_SUMMARY_NAMES))


_ROLLUP_KEYS = ("line", "shift", "date")
# keys of a grouping -> its grouping id: one bit per rollup key, set where it is not grouped by
_ROLLUP_IDS = {(): 7, ("line",): 3, ("shift",): 5, ("line", "shift"): 1, ("date",): 6}


def kpi_rollups(
    kpi: DataFrame, keys_of_views: Iterable[tuple[str, ...]] = tuple(_ROLLUP_IDS)
) -> DataFrame:
    """Sums for several of the summary, line, shift, line and shift, and date views in a single pass.

    Only the groupings asked for are computed. The result is small and meant to be staged;
    ``rollup_view`` takes single views from it.
    """
    groupings = [[F.col(c) for c in keys] for keys in keys_of_views]
    return kpi.groupingSets(groupings, *[F.col(c) for c in _ROLLUP_KEYS]).agg(
        F.grouping_id().alias("grouping"),
        F.count(F.lit(1)).alias("shift_count"),
        *[F.sum(c).alias(c) for c in SUMS],
    )


def rollup_view(rollups: DataFrame, *by: str) -> DataFrame:
    """One view of the rollups, equal to ``kpi_by`` or, without keys, to ``kpi_summary``."""
    rows = rollups.where(F.col("grouping") == _ROLLUP_IDS[by])
    if not by:
        # without any KPI row there is no group, but the summary still has its row
        names = dict(zip(SUMS, _SUMMARY_NAMES))
        return rows.agg(
            F.coalesce(F.sum("shift_count"), F.lit(0)).alias("kpi_records"),
            *[F.sum(source).alias(name) for source, name in names.items()],
        ).withColumns(_ratios_of_sums("kpi_records", *_SUMMARY_NAMES))
    return rows.select(*by, "shift_count", *SUMS).withColumns(
        _ratios_of_sums("shift_count", *SUMS)
    )


def downtime_pareto(
    kpi: DataFrame, single_task_reasons: int = PARETO_SINGLE_TASK_REASONS
) -> DataFrame:
    """Downtime per reason, its share and the running share from the largest down.

    The per-reason totals are staged, so the KPI rows are read once and the number of reasons
    is known before the way to run over them is chosen. Equal totals are ordered by reason.
    """
    totals = stage(
        kpi.groupBy("downtime_reason").agg(F.sum("downtime_min").alias("total_downtime_min")),
        "downtime-totals",
    )
    order = [F.desc("total_downtime_min"), F.asc_nulls_first("downtime_reason")]
    if totals.count() <= single_task_reasons:
        whole = Window.partitionBy()
        upwards = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        shared = totals.withColumns(
            {
                "running": F.sum("total_downtime_min").over(upwards),
                "grand": F.sum("total_downtime_min").over(whole),
            }
        )
    else:
        grand = totals.agg(F.sum("total_downtime_min")).first()[0]
        shared = running_total(totals, order, "total_downtime_min", "running").withColumn(
            "grand", F.lit(grand).cast("bigint")
        )
    return shared.select(
        "downtime_reason",
        "total_downtime_min",
        safe_divide(F.col("total_downtime_min"), F.col("grand")).alias("downtime_share"),
        safe_divide(F.col("running"), F.col("grand")).alias("cumulative_downtime_share"),
    ).orderBy(*order)
