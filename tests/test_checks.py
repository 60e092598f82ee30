from shiftledger.operators import checks
from shiftledger.plans.marts import build_marts

from .logs import raw_logs, staged_logs, validated_logs


def test_suite_has_all_declared_checks():
    assert checks.suite_size() == 89
    kinds = [kind for declared in checks.SUITE.values() for kind, d in declared.items() for _ in d]
    assert {k: kinds.count(k) for k in kinds} == {
        "not_null": 73,
        "unique": 7,
        "accepted_values": 6,
        "unique_combination": 3,
    }


def test_single_checks(spark):
    stg = staged_logs(spark, {}, {}, {"shift": "D", "line": None}, {"shift": None})
    nulls = {r.column_name: r.failures for r in checks.not_null(stg, ["shift", "line"]).collect()}
    assert nulls == {"shift": 1, "line": 1}
    assert [r.n_rows for r in checks.unique(stg, "shift_log_id").collect()] == [2]
    assert [tuple(r) for r in checks.accepted_values(stg, "shift").collect()] == [("D", 1)]
    combos = checks.unique_combination(stg, ["shift", "line"]).collect()
    assert [tuple(r) for r in combos] == [("A", "Saw 1", 2)]


def test_one_to_one(spark):
    raw = raw_logs(spark, {}, {}, {})
    assert checks.row_id_one_to_one(raw, raw).count() == 0
    lost = checks.row_id_one_to_one(raw, raw.where("row_number < 3")).collect()
    assert [(r.row_id, r.raw_rows, r.validated_rows) for r in lost] == [("id-0003", 1, 0)]
    twice = checks.row_id_one_to_one(raw, raw.union(raw.where("row_number = 1"))).collect()
    assert [(r.row_id, r.validated_rows) for r in twice] == [("id-0001", 2)]


def test_suite_results(spark):
    validated = validated_logs(spark, {}, {"line": "L2"}, {"shift": "D", "line": "L3"})
    results = checks.run_checks(build_marts(validated))
    rows = {(r.model, r.check_name, r.column_name): r for r in results.collect()}
    assert len(rows) == 89 and tuple(results.columns) == checks.RESULT_COLUMNS
    failed = {k: r.failures for k, r in rows.items() if r.status == "fail"}
    assert failed == {
        ("stg_shift_log_validated", "accepted_values", "shift"): 1,
        ("shift_log_validated_dedup", "accepted_values", "shift"): 1,
    }
    absent = [k for k, r in rows.items() if r.status == "column missing"]
    assert absent == [("stg_shift_log_validated", "not_null", "production_date")]


def test_suite_over_some_models(spark):
    views = build_marts(validated_logs(spark, {}), ["v_dq_metrics_by_run"])
    assert checks.run_checks(views).count() == 11 + 10
