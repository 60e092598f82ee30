from pyspark.sql import functions as F

from shiftledger import schemas as S
from shiftledger.operators import RULES, flag_duplicates, normalize_records, split_by_validity
from shiftledger.operators import validate
from shiftledger.operators.dedup import dedup_latest, validated_dedup
from shiftledger.plans.operations import kpi_of_staged, shift_log_kpi

from .logs import by_row, raw_logs, staged_logs, validated_logs


def reasons(spark, *changes):
    return [r for (r,) in by_row(validated_logs(spark, *changes), "invalid_reason")]


def test_valid_record(spark):
    rows = by_row(
        validated_logs(spark, {}), "is_valid", "invalid_reason", "is_duplicate", "shift_log_id"
    )
    assert rows == [(True, [], False, "9bc71558-e071-5697-8c71-b6c9986594f3")]


def test_each_rule_text(spark):
    cases = {
        S.DATE_MISSING: {"date": "  "},
        S.DATE_PARSE_FAILED: {"date": "2026-02-30"},
        S.PLANNED_OUTPUT_BAD: {"planned_output": "0"},
        S.ACTUAL_OUTPUT_BAD: {"actual_output": None},
        S.DEFECT_QTY_BAD: {"defect_qty": "-1"},
        S.DEFECT_OVER_ACTUAL: {"defect_qty": "609"},
        S.DOWNTIME_BAD: {"downtime_min": "x"},
        S.DOWNTIME_OVER_LIMIT: {"downtime_min": "481"},
        S.SHIFT_BAD: {"shift": "D"},
        S.LINE_MISSING: {"line": ""},
    }
    changes = [{"source_file": f"f{i}", **change} for i, change in enumerate(cases.values())]
    rows = validated_logs(spark, *changes).orderBy("row_number").select("invalid_reason").collect()
    assert [r[0] for r in rows] == [[text] for text in cases]


def test_reasons_are_sorted_and_limits_are_inclusive(spark):
    got = reasons(
        spark,
        {"actual_output": "-5", "defect_qty": "0"},
        {"downtime_min": "480", "line": "L2"},
        {"actual_output": "0", "defect_qty": "0", "line": "L3"},
        {"date": None, "shift": None, "line": None, "planned_output": ""},
    )
    assert got == [
        [S.ACTUAL_OUTPUT_BAD, S.DEFECT_OVER_ACTUAL],
        [],
        [],
        [S.DATE_MISSING, S.LINE_MISSING, S.PLANNED_OUTPUT_BAD, S.SHIFT_BAD],
    ]


def test_duplicate_keeps_the_first_even_if_invalid(spark):
    rows = by_row(
        validated_logs(spark, {"planned_output": "x"}, {}, {}), "is_duplicate", "is_valid"
    )
    assert rows == [(False, False), (True, False), (True, False)]


def test_duplicate_key_is_raw_text(spark):
    flags = by_row(
        validated_logs(
            spark,
            {"shift": " a"},
            {"shift": "A"},
            {"date": "05.01.2026"},
            {"line": ""},
            {"line": ""},
            {"line": "  "},
            {"line": "  "},
            {"line": None},
            {"line": None},
            {"run_id": "run-2"},
            {"source_file": "other.csv"},
        ),
        "is_duplicate",
    )
    assert [f for (f,) in flags] == [False] * 6 + [True] + [False] * 4


def test_same_key_for_different_spellings(spark):
    ids = by_row(
        validated_logs(spark, {"shift": " a"}, {}, {"date": "05.01.2026"}), "shift_log_id"
    )
    assert len(set(ids)) == 1


def test_duplicates_by_normalised_key(spark):
    normalized = normalize_records(raw_logs(spark, {"shift": " a"}, {"date": "5/1/2026"}, {}))
    flagged = flag_duplicates(
        normalized, keys=("production_date", "shift_normalized", "line_normalized")
    )
    assert by_row(flagged, "is_duplicate") == [(False,), (True,), (True,)]


def test_key_with_a_third_of_all_rows(spark):
    """Hot keys take the aggregation, ordinary ones the window; both must agree."""
    changes = []
    for i in range(600):
        if i % 3 == 0:
            changes.append({"line": "hot"})
        elif i % 3 == 1:
            changes.append({"line": f"line{i % 41}", "source_file": f"f{i % 2}"})
        else:
            changes.append({"line": "", "date": None})
    raw = raw_logs(spark, *changes)
    seen, expected = set(), []
    for r in raw.orderBy("row_number").collect():
        key = (r.run_id, r.source_file, r.date, r.shift, r.line)
        usable = bool(r.date and r.shift and r.line)
        expected.append((usable and key in seen,))
        if usable:
            seen.add(key)
    for hot_rows in (1, 20, 100, 10_000):
        flagged = flag_duplicates(raw, hot_rows=hot_rows, probe_fraction=1.0)
        assert by_row(flagged, "is_duplicate") == expected
    assert by_row(flag_duplicates(raw), "is_duplicate") == expected


def test_result_does_not_depend_on_partitioning(spark):
    changes = [{"line": f"L{i % 7}", "row_number": i + 1} for i in range(60)]
    raw = raw_logs(spark, *changes)
    one = by_row(flag_duplicates(raw.repartition(1)), "row_number", "is_duplicate")
    many = by_row(flag_duplicates(raw.repartition(13)), "row_number", "is_duplicate")
    assert one == many


def test_production_date_rule_on_text(spark):
    df = flag_duplicates(normalize_records(raw_logs(spark, {}, {"line": "2"}, {"line": "3"})))
    texts = F.create_map(
        F.lit("Saw 1"), F.lit("2026-01-05"), F.lit("2"), F.lit("05.01.2026"), F.lit("3"), F.lit("2026-02-30")
    )
    df = df.withColumn("production_date", texts[F.col("line")])
    got = [r for (r,) in by_row(validate(df), "invalid_reason")]
    assert got == [[], [S.PRODUCTION_DATE_INVALID], [S.PRODUCTION_DATE_INVALID]]


def test_own_rules(spark):
    rules = {"downtime_min is over 480": RULES[S.DOWNTIME_OVER_LIMIT]}
    got = validated_logs(spark, {"downtime_min": "500"}, {"shift": "D", "line": "x"}, rules=rules)
    assert by_row(got, "invalid_reason") == [([S.DOWNTIME_OVER_LIMIT],), ([],)]


def test_split(spark):
    df = validated_logs(spark, {}, {"shift": "D"}, {"line": "x"})
    valid, invalid = split_by_validity(df)
    assert by_row(valid, "row_number") == [(1,), (3,)]
    assert by_row(invalid, "row_number") == [(2,)]


def test_latest_wins_before_validity_is_tested(spark):
    staged = staged_logs(spark, {}, {})
    kept = dedup_latest(staged).collect()
    assert [r.row_id for r in kept] == ["id-0002"] and not kept[0].is_valid
    assert kpi_of_staged(staged).count() == 0
    best = dedup_latest(staged, valid_first=True).collect()
    assert [r.row_id for r in best] == ["id-0001"]


def test_dedup_prefers_later_ingestion(spark):
    from datetime import timedelta

    from .logs import DAY

    staged = staged_logs(
        spark,
        {"ingested_at": DAY + timedelta(days=1), "run_id": "run-2"},
        {"row_id": "zzz"},
    )
    assert [r.row_id for r in dedup_latest(staged).collect()] == ["id-0001"]


def test_records_without_key_pass_through(spark):
    staged = staged_logs(spark, {"line": ""}, {"line": ""}, {}, {})
    view = validated_dedup(staged)
    assert view.count() == 3
    assert view.where("shift_log_id is null").count() == 2
    again = validated_dedup(view)
    assert sorted(map(str, again.collect())) == sorted(map(str, view.collect()))
    assert shift_log_kpi(view).count() == kpi_of_staged(staged).count()
