"""Declarative data checks: each returns its failing rows or groups, so empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SHIFTS

RESULT_COLUMNS = ("model", "check_name", "column_name", "failures", "status")


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: its name and number of NULLs, all counted in a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], list(cols), "column_name", "failures")


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once, with their number of rows."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique(df: DataFrame, col: str) -> DataFrame:
    """Repeated values of one column; NULL is no value."""
    return unique_combination(df.where(F.col(col).isNotNull()), [col])


def accepted_values(df: DataFrame, col: str, values: Sequence[str] = SHIFTS) -> DataFrame:
    """Values outside the list with their number of rows; NULL is no value."""
    return (
        df.where(~F.col(col).isin(*values)).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def row_id_one_to_one(raw: DataFrame, validated: DataFrame) -> DataFrame:
    """Row ids that do not occur exactly once on both sides.

    One aggregation over both id columns; it also finds ids repeated on one side, which two
    anti joins would miss.
    """
    sides = raw.select("row_id", F.lit(1).alias("r"), F.lit(0).alias("v")).unionByName(
        validated.select("row_id", F.lit(0).alias("r"), F.lit(1).alias("v"))
    )
    return (
        sides.groupBy("row_id")
        .agg(F.sum("r").alias("raw_rows"), F.sum("v").alias("validated_rows"))
        .where((F.col("raw_rows") != 1) | (F.col("validated_rows") != 1))
    )


_KPI_SUMS = ("planned_output", "actual_output", "defect_qty", "downtime_min")
_GROUP_COUNTS = ("shift_count", *_KPI_SUMS)

# fixed values: the 89 declared checks, by model
SUITE: dict[str, dict] = {
    "stg_shift_log_validated": {
        "not_null": ["row_id", "production_date", "shift", "line", *_KPI_SUMS, "is_valid"],
        "unique": ["row_id"],
        "accepted_values": {"shift": SHIFTS},
    },
    "shift_log_validated_dedup": {
        "not_null": ["date", "line", "shift"],
        "unique": ["shift_log_id"],
        "accepted_values": {"shift": SHIFTS},
    },
    "v_dq_metrics_by_run": {
        "not_null": [
            "run_id",
            "source_file",
            "total_rows",
            "rows_valid",
            "rows_invalid",
            "valid_rate",
            "duplicate_rows",
            "duplicate_rate",
            "numeric_parse_error_rate",
        ],
        "unique_combination": [("run_id", "source_file")],
    },
    "v_dq_invalid_reasons_by_run": {
        "not_null": ["run_id", "source_file", "invalid_reason", "rows_count"],
        "unique_combination": [("run_id", "source_file", "invalid_reason")],
    },
    "shift_log_kpi": {
        "not_null": [
            "shift_log_id",
            "date",
            "shift",
            "line",
            *_KPI_SUMS,
            "production_achievement",
        ],
        "unique": ["shift_log_id"],
        "accepted_values": {"shift": SHIFTS},
    },
    "v_manufacturing_kpi_summary": {
        "not_null": [
            "kpi_records",
            "total_planned_output",
            "total_actual_output",
            "total_defects",
            "total_downtime_min",
        ],
    },
    "v_manufacturing_kpi_daily_trend": {
        "not_null": ["date", *_GROUP_COUNTS],
        "unique": ["date"],
    },
    "v_manufacturing_kpi_by_line": {
        "not_null": ["line", *_GROUP_COUNTS],
        "unique": ["line"],
    },
    "v_manufacturing_kpi_by_shift": {
        "not_null": ["shift", *_GROUP_COUNTS],
        "unique": ["shift"],
        "accepted_values": {"shift": SHIFTS},
    },
    "v_downtime_reason_pareto": {
        "not_null": ["downtime_reason", "total_downtime_min"],
        "unique": ["downtime_reason"],
    },
    "v_line_shift_performance": {
        "not_null": ["line", "shift", *_GROUP_COUNTS],
        "accepted_values": {"shift": SHIFTS},
        "unique_combination": [("line", "shift")],
    },
    "v_shift_log_kpi_drilldown": {
        "not_null": ["date", "shift", "line", *_KPI_SUMS],
        "accepted_values": {"shift": SHIFTS},
    },
}


def suite_size(suite: Mapping[str, dict] = SUITE) -> int:
    return sum(len(declared) for checks in suite.values() for declared in checks.values())


def _declared(suite: Mapping[str, dict], frames: Mapping[str, DataFrame]) -> list[tuple]:
    """Every check on the given models: model, kind, columns, accepted values."""
    found = []
    for model, checks in suite.items():
        if model in frames:
            found += [(model, "not_null", (c,), None) for c in checks.get("not_null", ())]
            found += [(model, "accepted_values", (c,), v) for c, v in checks.get("accepted_values", {}).items()]
            found += [(model, "unique", (c,), None) for c in checks.get("unique", ())]
            found += [(model, "unique_combination", tuple(c), None) for c in checks.get("unique_combination", ())]
    return found


def _finding(number: int, value: Column) -> Column:
    return F.struct(F.lit(number).alias("number"), value.alias("value"))


def _findings(df: DataFrame, checks: Sequence[tuple[int, tuple]]) -> DataFrame:
    """``number`` of a check and a ``value``, in one pass over a model.

    Uniqueness takes a row for every value, the other checks one for every failure, so a record
    without failures is spread over its unique columns only.
    """
    always, seldom, failing = [], [], F.lit(False)
    for number, (_, kind, cols, accepted) in checks:
        value = F.col(cols[0])
        if kind == "unique":
            always.append(F.when(value.isNotNull(), _finding(number, value.cast("string"))))
        elif kind == "unique_combination":
            always.append(_finding(number, F.to_json(F.struct(*cols))))
        else:
            fails = value.isNull() if kind == "not_null" else value.isNotNull() & ~value.isin(*accepted)
            shown = F.lit("") if kind == "not_null" else value.cast("string")
            seldom.append(F.when(fails, _finding(number, shown)))
            failing = failing | fails
    usual = F.array(*always) if always else F.array().cast("array<struct<number:int,value:string>>")
    entries = F.when(failing, F.array(*always, *seldom)).otherwise(usual) if seldom else usual
    found = df.select(F.explode(entries).alias("found")).where(F.col("found").isNotNull())
    return found.select("found.number", "found.value")


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union in a balanced tree: each step analyses its inputs again."""
    while len(parts) > 1:
        parts = [
            left.union(right[0]) if right else left
            for left, *right in (parts[i : i + 2] for i in range(0, len(parts), 2))
        ]
    return parts[0]


def run_checks(frames: Mapping[str, DataFrame], suite: Mapping[str, dict] = SUITE) -> DataFrame:
    """One result row per declared check over the given models.

    A failing check is a result, not an error. A check on a column the model lacks is reported
    as "column missing". Models absent from ``frames`` are skipped. Each model is read once, and
    all checks of all models share one exchange of values, counted in every task before.
    """
    declared = _declared(suite, frames)
    lacking = {n for n, (model, _, cols, _) in enumerate(declared) if not set(frames[model].columns).issuperset(cols)}
    parts = []
    for model, df in frames.items():
        its = [(n, check) for n, check in enumerate(declared) if check[0] == model and n not in lacking]
        if its:
            parts.append(_findings(df, its))
    kind, values, repeated = F.col("check_name"), F.col("values"), F.col("repeated")
    entries = [
        F.struct(
            F.lit(n).alias("number"),
            F.lit(model).alias("model"),
            F.lit(check).alias("check_name"),
            F.lit(", ".join(cols)).alias("column_name"),
            F.lit(n in lacking).alias("lacking"),
        )
        for n, (model, check, cols, _) in enumerate(declared)
    ]
    spark = next(iter(frames.values())).sparkSession
    rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))
    failures = F.lit(0).cast("bigint")
    if parts:
        counted = _union(parts).groupBy("number", "value").agg(F.count(F.lit(1)).alias("n"))
        per_check = counted.groupBy("number").agg(
            F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"), F.count_if(F.col("n") > 1).alias("repeated")
        )
        # one row per check at most
        rows = rows.join(F.broadcast(per_check), "number", "left")
        found = F.when(kind == "not_null", F.col("rows")).when(kind == "accepted_values", values).otherwise(repeated)
        failures = F.coalesce(found, failures)
    status = F.when(F.col("lacking"), "column missing").when(F.col("failures") == 0, "pass").otherwise("fail")
    return rows.withColumn("failures", F.when(~F.col("lacking"), failures)).select(
        "model", "check_name", "column_name", "failures", status.alias("status")
    )
