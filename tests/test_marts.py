import pytest
from pyspark.sql import functions as F

from querybook.frames import kpi, staged, stored_validated
from shiftledger import schemas as S
from shiftledger.operators.running import running_total
from shiftledger.plans import measures, operations, quality
from shiftledger.plans.marts import UPSTREAM, build_marts, publish_views, with_upstream

from .logs import staged_logs, validated_logs


def test_golden_values(spark, sf_dir):
    per_run = stored_validated(spark, sf_dir).groupBy("run_id").agg(
        F.count("*"), F.count_if("is_valid"), F.count_if("is_duplicate"), F.count("shift_log_id")
    )
    assert [tuple(r)[1:] for r in per_run.orderBy("run_id").collect()] == [
        (520, 404, 11, 491),
        (520, 396, 11, 487),
        (520, 396, 11, 485),
    ]
    rows = kpi(spark, sf_dir)
    summary = operations.kpi_summary(rows).first()
    assert tuple(summary)[:5] == (1118, 985524, 894628, 15739, 55172)
    assert {r["shift"]: r.shift_count for r in operations.kpi_by_shift(rows).collect()} == {
        "A": 333,
        "B": 446,
        "C": 339,
    }
    assert {r.line: r.shift_count for r in operations.kpi_by_line(rows).collect()} == {
        "Line1": 336,
        "Line2": 266,
        "Line3": 263,
        "Line4": 253,
    }
    reasons = quality.dq_invalid_reasons_by_run(staged(spark, sf_dir))
    totals = reasons.groupBy("invalid_reason").agg(F.sum("rows_count")).collect()
    assert dict(map(tuple, totals)) == {
        S.DUPLICATE_RECORD: 33,
        S.ACTUAL_OUTPUT_BAD: 46,
        S.DATE_MISSING: 32,
        S.DATE_PARSE_FAILED: 15,
        S.DEFECT_OVER_ACTUAL: 50,
        S.DEFECT_QTY_BAD: 30,
        S.DOWNTIME_BAD: 72,
        S.DOWNTIME_OVER_LIMIT: 33,
        S.LINE_MISSING: 19,
        S.PLANNED_OUTPUT_BAD: 40,
        S.SHIFT_BAD: 33,
    }


def test_no_rows_at_all(spark):
    empty = operations.kpi_of_staged(staged_logs(spark, {}).where("false"))
    assert [tuple(r) for r in operations.kpi_summary(empty).collect()] == [(0,) + (None,) * 7]
    assert operations.kpi_by_line(empty).count() == 0
    assert operations.downtime_pareto(empty).count() == 0
    rates = measures.report_measures(empty).first()
    assert (rates.achievement_rate, rates.defect_rate, rates.output_variance_pct) == (0.0, 0.0, 0.0)


def test_zero_actual_and_zero_downtime(spark):
    rows = operations.kpi_of_staged(
        staged_logs(spark, {"actual_output": "0", "defect_qty": "0", "downtime_min": "0"})
    )
    assert rows.first().defect_rate is None
    only = operations.downtime_pareto(rows).first()
    assert (only.downtime_share, only.cumulative_downtime_share) == (None, None)


def _reason_logs(spark):
    minutes = [30, 10, 10, 20, 10, 0, 5]
    return operations.kpi_of_staged(
        staged_logs(
            spark,
            *[
                {"line": f"L{i}", "downtime_min": str(m), "downtime_reason": r}
                for i, (m, r) in enumerate(zip(minutes, ["a", "b", "c", "d", None, "e", ""]))
            ],
        )
    )


@pytest.mark.parametrize("single_task_reasons", [100, 0])
def test_pareto_both_ways(spark, single_task_reasons):
    rows = operations.downtime_pareto(_reason_logs(spark), single_task_reasons).collect()
    assert [(r.downtime_reason, r.total_downtime_min) for r in rows] == [
        ("a", 30),
        ("d", 20),
        (None, 10),
        ("b", 10),
        ("c", 10),
        ("", 5),
        ("e", 0),
    ]
    running = [30, 50, 60, 70, 80, 85, 85]
    assert [round(r.cumulative_downtime_share * 85) for r in rows] == running
    assert [round(r.downtime_share * 85) for r in rows] == [30, 20, 10, 10, 10, 5, 0]


def test_running_total_over_many_ranges(spark):
    df = spark.range(5000).select("id", (F.col("id") % 17).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    got = running_total(df.repartition(6), order, "v", "total").orderBy(*order).collect()
    total = 0
    for row in got:
        total += row.v
        assert row.total == total


def test_trend_uses_raw_date_text(spark):
    rows = operations.kpi_of_staged(
        staged_logs(spark, {}, {"date": "2026/01/05", "shift": "B"}, {"shift": "C"})
    )
    counts = {r.date: r.shift_count for r in operations.kpi_daily_trend(rows).collect()}
    assert counts == {"2026-01-05": 2, "2026/01/05": 1}


def test_metrics_catalogue(spark):
    stg = staged_logs(spark, {}, {}, {"planned_output": "x", "shift": "D"})
    usual = quality.dq_metrics_by_run(stg).first()
    assert len(usual) == 29
    assert (usual.total_rows, usual.rows_valid, usual.rows_invalid) == (3, 1, 2)
    assert (usual.duplicate_rows, usual.unique_shift_logs, usual.invalid_shift_rows) == (1, 2, 1)
    assert usual.planned_output_parse_failed_rows == 0 and usual.numeric_parse_error_rate == 0.0
    own = {**S.METRIC_REASONS, "planned_output_parse_failed": S.PLANNED_OUTPUT_BAD}
    assert quality.dq_metrics_by_run(stg, own).first().planned_output_parse_failed_rows == 1


def test_null_reason_array_counts_as_empty(spark):
    stg = staged_logs(spark, {}).withColumn("invalid_reason", F.lit(None).cast("array<string>"))
    assert quality.dq_metrics_by_run(stg).first().unique_shift_logs == 1
    assert quality.dq_invalid_reasons_by_run(stg).count() == 0


def test_reasons_view_is_sorted(spark, sf_dir):
    rows = quality.dq_invalid_reasons_by_run(staged(spark, sf_dir)).collect()
    order = [(r.run_id, -r.rows_count) for r in rows]
    assert order == sorted(order)


def test_report_filter_pushes_down(spark, sf_dir):
    table = staged(spark, sf_dir)
    filtered = measures.report_filter(table, run_ids=["r"], shifts=["A"])
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(run_id,r)" in plan


def test_build_chosen_marts(spark):
    assert with_upstream(["v_manufacturing_kpi_by_line"]) == [
        "stg_shift_log_validated",
        "shift_log_validated_dedup",
        "shift_log_kpi",
        "v_manufacturing_kpi_by_line",
    ]
    with pytest.raises(ValueError, match="unknown view"):
        with_upstream(["nothing"])
    validated = validated_logs(spark, {}, {"line": "L2"}, {"line": ""})
    few = build_marts(validated, ["v_dq_metrics_by_run"])
    assert list(few) == ["stg_shift_log_validated", "v_dq_metrics_by_run"]
    views = build_marts(validated)
    assert list(views) == list(UPSTREAM)
    assert views["shift_log_validated_dedup"].count() == 3
    assert views["shift_log_kpi"].count() == 2
    assert views["v_manufacturing_kpi_by_line"].count() == 2


def test_own_rules_may_leave_valid_records_without_key(spark):
    validated = validated_logs(spark, {"line": ""}, {}, rules={})
    views = build_marts(validated)
    assert views["shift_log_kpi"].count() == 2
    assert views["v_manufacturing_kpi_summary"].first().kpi_records == 2


def test_rollups_equal_the_single_views(spark, sf_dir):
    rows = kpi(spark, sf_dir)
    rollups = operations.kpi_rollups(rows)
    for by in (("line",), ("shift",), ("line", "shift"), ("date",)):
        ours, single = operations.rollup_view(rollups, *by), operations.kpi_by(rows, *by)
        assert ours.columns == single.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, single.collect()))
    for source in (rows, rows.where("false")):
        total = operations.rollup_view(operations.kpi_rollups(source))
        assert total.collect() == operations.kpi_summary(source).collect()


def test_kpi_without_dedup(spark):
    rows = operations.kpi_without_dedup(validated_logs(spark, {}, {"shift": "D"}))
    row = rows.first()
    assert rows.count() == 1 and "is_valid" not in rows.columns
    assert row.production_achievement == 0.95 and row.downtime_rate == 24 / 480


def test_aggregated_views_stage_few_columns(spark, tmp_path):
    validated = validated_logs(spark, {}, {"line": "L2", "downtime_min": "7"}, {"shift": "D"})
    names = ["v_manufacturing_kpi_by_line", "v_manufacturing_kpi_by_shift", "v_downtime_reason_pareto"]
    few, whole = build_marts(validated, names), build_marts(validated)
    for name in few:
        assert sorted(map(str, few[name].collect())) == sorted(map(str, whole[name].collect())), name


def test_published_views(spark):
    publish_views(build_marts(validated_logs(spark, {}, {"line": "L2"}), ["v_manufacturing_kpi_by_line"]))
    assert spark.sql("SELECT sum(shift_count) FROM v_manufacturing_kpi_by_line").first()[0] == 2
