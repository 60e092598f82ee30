"""All views built together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from ..operators.dedup import dedup_latest
from ..session import stage
from . import operations as ops
from . import quality
from .staging import stg_shift_logs

# view -> the view it reads
UPSTREAM = {
    "stg_shift_log_validated": None,
    "shift_log_validated_dedup": "stg_shift_log_validated",
    "v_dq_metrics_by_run": "stg_shift_log_validated",
    "v_dq_invalid_reasons_by_run": "stg_shift_log_validated",
    "shift_log_kpi": "shift_log_validated_dedup",
    "v_manufacturing_kpi_summary": "shift_log_kpi",
    "v_manufacturing_kpi_daily_trend": "shift_log_kpi",
    "v_manufacturing_kpi_by_line": "shift_log_kpi",
    "v_manufacturing_kpi_by_shift": "shift_log_kpi",
    "v_downtime_reason_pareto": "shift_log_kpi",
    "v_line_shift_performance": "shift_log_kpi",
    "v_shift_log_kpi_drilldown": "shift_log_kpi",
}

# views that are one grouping of the KPI rows -> its keys
_GROUPINGS = {
    "v_manufacturing_kpi_summary": (),
    "v_manufacturing_kpi_daily_trend": ("date",),
    "v_manufacturing_kpi_by_line": ("line",),
    "v_manufacturing_kpi_by_shift": ("shift",),
    "v_line_shift_performance": ("line", "shift"),
}


def with_upstream(names: Iterable[str]) -> list[str]:
    """The named views and everything they read, in dependency order."""
    wanted: set[str] = set()
    for name in names:
        if name not in UPSTREAM:
            raise ValueError(f"unknown view: {name}")
        while name is not None:
            wanted.add(name)
            name = UPSTREAM[name]
    return [name for name in UPSTREAM if name in wanted]


# what the aggregated operations views read of the KPI rows
_OF_KPI_ROWS = (
    "date", "shift", "line", "planned_output", "actual_output", "defect_qty", "downtime_min",
    "downtime_reason",
)
_RECORD_LEVEL = {"shift_log_validated_dedup", "shift_log_kpi", "v_shift_log_kpi_drilldown"}


def build_marts(validated: DataFrame, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The views over a validated table, or the named ones with their upstream.

    Calling this starts jobs; inside a ``lease`` what they stage is removed when it ends. Record-level views stay lazy. What several views would compute again is computed once and
    staged as a columnar table in the shared work area: the deduplicated rows, which
    up to eight views read (where only aggregated views are asked for: the eight columns of the
    KPI rows that these read), and the sums of the wanted groupings of the KPI rows. Aggregated quality
    views are staged too, since a dashboard and the checks read them several times.
    """
    wanted = list(UPSTREAM if names is None else names)
    order = with_upstream(wanted)
    staged = stg_shift_logs(validated)
    of_kpi = [name for name in order if UPSTREAM[name] == "shift_log_kpi"]
    groupings = [name for name in of_kpi if name in _GROUPINGS]

    whole_records = not _RECORD_LEVEL.isdisjoint(wanted)
    # the second part adds no KPI row under the standard rules, and its filters (no key, valid)
    # let the scan skip nearly every row group
    dedup = dedup_latest(staged).unionByName(staged.where(staged["shift_log_id"].isNull()))
    if len(of_kpi) > 1 and whole_records:
        dedup = stage(dedup, "dedup")
    kpi = ops.shift_log_kpi(dedup)
    measured = kpi
    if len(of_kpi) > 1 and not whole_records:
        measured = stage(kpi.select(*_OF_KPI_ROWS), "kpi")
    rollups = None
    if len(groupings) > 1:
        rollups = stage(ops.kpi_rollups(measured, [_GROUPINGS[name] for name in groupings]), "rollups")

    def view(name: str) -> DataFrame:
        if name == "stg_shift_log_validated":
            return staged
        if name == "shift_log_validated_dedup":
            return dedup
        if name == "v_dq_metrics_by_run":
            return stage(quality.dq_metrics_by_run(staged), "metrics")
        if name == "v_dq_invalid_reasons_by_run":
            counts = stage(quality.invalid_reason_counts(staged), "reasons")
            return quality.most_frequent_first(counts)
        if name == "shift_log_kpi":
            return kpi
        if name == "v_downtime_reason_pareto":
            return ops.downtime_pareto(measured)
        if name == "v_shift_log_kpi_drilldown":
            return ops.kpi_drilldown(kpi)
        keys = _GROUPINGS[name]
        if rollups is not None:
            return ops.rollup_view(rollups, *keys)
        return ops.kpi_by(measured, *keys) if keys else ops.kpi_summary(measured)

    return {name: view(name) for name in order}


def publish_views(views: Mapping[str, DataFrame], base: str | None = None) -> None:
    """Make views readable by name in SQL.

    Without ``base`` they become temporary views of the session; with ``base`` (``schema`` or
    ``catalog.schema``) each is written as a table there, replacing the one of that name. A
    table must not replace one its own view still reads.
    """
    for name, df in views.items():
        if base is None:
            df.createOrReplaceTempView(name)
        else:
            df.write.mode("overwrite").saveAsTable(f"{base}.{name}")
