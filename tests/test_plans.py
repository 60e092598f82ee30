"""Shape of the physical plans that matter at scale."""

from pyspark.sql import functions as F

from querybook.frames import kpi, staged, stored_raw, stored_validated, validated
from querybook.queries import check_suite
from shiftledger.operators import dedup_latest, duplicates
from shiftledger.plans import operations
from shiftledger.functions import assemble_reasons
from shiftledger.operators import flag_duplicates
from shiftledger.plans.measures import report_filter


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_on_the_data_path(spark, sf_dir):
    for df in (validated(spark, sf_dir), kpi(spark, sf_dir), operations.kpi_by_line(kpi(spark, sf_dir))):
        plan = plan_of(df)
        assert "Python" not in plan and "Arrow" not in plan


def exchange_keys(plan):
    """Number of partitioning columns of each hash exchange."""
    keys = [line.split("hashpartitioning(")[1].split("), ENSURE")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    return [len(k.split(", ")) - 1 for k in keys]


def test_validation_shuffles_the_records_once(spark, sf_dir):
    """One exchange by key and spread column; those of the hot-key probe carry only keys."""
    plan = plan_of(validated(spark, sf_dir))
    assert exchange_keys(plan) == [6, 5, 5]
    assert plan.count("Window [") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_probe_without_hot_keys_reads_the_records_no_second_time(spark, sf_dir):
    df = validated(spark, sf_dir).select("is_duplicate")
    assert "min(struct(row_number" in plan_of(df)
    df.collect()
    final, initial = plan_of(df).split("Initial Plan")
    assert "min(struct(row_number" not in final and "min(struct(row_number" in initial


def test_dedup_ranks_before_the_shuffle(spark, sf_dir):
    lines = plan_of(dedup_latest(staged(spark, sf_dir))).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any(i > exchange for i in limits) and any(i < exchange for i in limits)


def test_marts_read_few_columns(spark, sf_dir):
    plan = plan_of(operations.kpi_by_line(kpi(spark, sf_dir)))
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line).split("ReadSchema")[1]
    assert "operator" not in schema and "invalid_reason" not in schema
    assert "IsNotNull(shift_log_id)" in plan


def test_validity_stays_above_the_ranking(spark, sf_dir):
    """Pushed below it, a superseded valid record could come back."""
    lines = plan_of(kpi(spark, sf_dir)).split("\n")
    lines = lines[: next(i for i, line in enumerate(lines) if "FileScan" in line) + 1]
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    filters = [i for i, line in enumerate(lines) if "+- Filter" in line and "is_valid" in line]
    assert filters and max(filters) < window
    scan = next(line for line in lines if "FileScan" in line)
    assert "is_valid" not in scan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_slicers_reach_the_scan(spark, sf_dir):
    plan = plan_of(report_filter(stored_validated(spark, sf_dir), source_files=["a", "b"]))
    assert "In(source_file, [a,b])" in plan
    assert stored_raw(spark, sf_dir).where(F.col("run_id") == "x").count() == 0


def test_check_suite_scans(spark, sf_dir):
    """One scan per model, and one exchange of values for all checks of all models."""
    plan = plan_of(check_suite(spark, sf_dir))
    assert plan.count("FileScan") <= 14 and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning(number") == 2


def test_duplicate_flag_moves_rows_once(spark):
    """Hot keys are sent to the rows, so neither the pass for them nor the join with them shuffles rows."""
    rows = spark.range(9).selectExpr(
        "'r' run_id", "'f' source_file", "CAST(id % 4 AS STRING) date", "'A' shift", "'L' line", "id row_number", "CAST(id AS STRING) row_id"
    )
    flagged = flag_duplicates(rows)
    plan = flagged._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert sorted(r.row_number for r in flagged.collect() if r.is_duplicate) == [4, 5, 6, 7, 8]


def test_reasons_stay_in_generated_code(spark):
    parts = {t: F.col("id") % n == 0 for t, n in (("even", 2), ("a, b", 3))}
    found = spark.range(4).select(assemble_reasons(parts).alias("r"))
    assert "filter(" not in plan_of(found) and [r.r for r in found.collect()] == [["a, b", "even"], [], ["even"], ["a, b"]]
    odd = spark.range(1).select(assemble_reasons({"x\x1fy": F.lit(True), "z": F.lit(True)}).alias("r"))
    assert odd.first().r == ["x\x1fy", "z"]


def test_duplicate_flag_bounds_the_rows_of_a_task(spark, monkeypatch):
    """More rows are dealt to more tasks; the session's 8 shuffle partitions do not bound them."""
    rows = spark.range(3000).selectExpr(
        "'r' run_id", "'f' source_file", "CAST(id % 1500 AS STRING) date", "'A' shift", "'L' line", "id row_number", "CAST(id AS STRING) row_id"
    )
    monkeypatch.setattr(duplicates, "TASK_ROWS", 100)
    flagged = flag_duplicates(rows)
    assert flagged.columns == [*rows.columns, "is_duplicate"]
    tasks = flagged.groupBy(F.spark_partition_id()).count().collect()
    assert 20 < len(tasks) <= 30 and max(n for _, n in tasks) < 250
    assert sorted(r.row_number for r in flagged.collect() if r.is_duplicate) == list(range(1500, 3000))
