import os

import pytest

from shiftledger.plans import operations
from shiftledger.plans.marts import build_marts
from shiftledger.session import lease, stage, work_area

from .logs import staged_logs, validated_logs


def folders(spark):
    area = work_area(spark).removeprefix("file:")
    return set(os.listdir(area)) if os.path.isdir(area) else set()


def test_a_lease_leaves_no_folder(spark):
    validated = validated_logs(spark, {}, {"line": "L2"}, {"shift": "D", "line": "L3"})
    before = folders(spark)
    with lease(spark) as held:
        counts = {name: view.count() for name, view in build_marts(validated).items()}
        assert len(held) >= 4 and len(folders(spark) - before) == len(held)
    assert folders(spark) == before
    assert counts["shift_log_validated_dedup"] == 3


def test_a_failed_job_leaves_no_folder(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError), lease(spark):
        stage(spark.range(3), "numbers").count()
        raise RuntimeError
    with pytest.raises(Exception, match="no such column|cannot be resolved|boom"), lease(spark):
        stage(spark.range(3).selectExpr("raise_error('boom')"), "broken")
    assert folders(spark) == before


def test_leases_in_leases(spark):
    before = folders(spark)
    with lease(spark):
        kept = stage(spark.range(5), "outer")
        with lease(spark):
            stage(spark.range(3), "inner")
        assert kept.count() == 5 and len(folders(spark) - before) == 1
    assert folders(spark) == before
    free = stage(spark.range(2), "free")
    assert free.count() == 2 and len(folders(spark) - before) == 1


def test_only_the_groupings_asked_for(spark):
    kpi = operations.kpi_of_staged(staged_logs(spark, {}, {"line": "L2"}))
    rollups = operations.kpi_rollups(kpi, [("line",), ()])
    assert {r.grouping for r in rollups.collect()} == {3, 7}
    plan = rollups._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Expand [")[1].split("\n")[0].count("[") == 2 + 1  # two groupings, and the output
    assert operations.rollup_view(rollups, "line").count() == 2
    views = build_marts(validated_logs(spark, {}, {"line": "L2"}), ["v_manufacturing_kpi_by_line", "v_manufacturing_kpi_summary"])
    read = views["v_manufacturing_kpi_by_line"]._jdf.queryExecution().analyzed().toString()
    assert "grouping" in read and views["v_manufacturing_kpi_summary"].first().kpi_records == 2
