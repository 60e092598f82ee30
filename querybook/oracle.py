"""SQL twins of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

from datetime import timedelta

from shiftledger import schemas as S
from shiftledger.operators.checks import SUITE

from .frames import CHUNK, MESSY_KINDS
from .fx import FX_SQL, NAMESPACE
from .queries import INGESTED_AT, QUANTITIES, RUN_ID

SOURCE = S.SOURCE_COLUMNS
_FORMATS = "['%Y-%m-%d', '%Y/%m/%d', '%Y.%m.%d', '%d-%m-%Y', '%d/%m/%Y', '%d.%m.%Y']"
_NS_HEX = NAMESPACE.replace("-", "")


def _int(name: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({name}), '[+-]?[0-9]+(_[0-9]+)*') "
        f"THEN TRY_CAST(replace(trim({name}), '_', '') AS BIGINT) END"
    )


def _uuid(name: str) -> str:
    h = f"sha1(unhex('{_NS_HEX}') || encode({name}))"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"
    )


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def _sum(name: str) -> str:
    return f"CAST(SUM({name}) AS BIGINT)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- layers -----------------------------------------------------------------------

_NORMALIZED = f"""
  CAST(try_strptime(trim(date), {_FORMATS}) AS DATE) AS production_date,
  nullif(upper(trim(shift)), '') AS shift_normalized,
  nullif(trim(line), '') AS line_normalized,
  {", ".join(f"{_int(c)} AS {c}_int" for c in QUANTITIES)}"""


def _duplicate(keys: str, scope: str, usable: str) -> str:
    return (
        f"({usable}) AND row_number() OVER (PARTITION BY {scope}, {keys}, ({usable}) "
        "ORDER BY row_number) > 1"
    )


_RAW_USABLE = "coalesce(date, '') <> '' AND coalesce(shift, '') <> '' AND coalesce(line, '') <> ''"

_CONDITIONS = {
    S.DATE_MISSING: "coalesce(trim(date), '') = ''",
    S.DATE_PARSE_FAILED: "trim(date) <> '' AND production_date IS NULL",
    S.DUPLICATE_RECORD: "is_duplicate",
    S.PLANNED_OUTPUT_BAD: "planned_output_int IS NULL OR planned_output_int <= 0",
    S.ACTUAL_OUTPUT_BAD: "actual_output_int IS NULL OR actual_output_int < 0",
    S.DEFECT_QTY_BAD: "defect_qty_int IS NULL OR defect_qty_int < 0",
    S.DEFECT_OVER_ACTUAL: "defect_qty_int > actual_output_int",
    S.DOWNTIME_BAD: "downtime_min_int IS NULL OR downtime_min_int < 0",
    S.DOWNTIME_OVER_LIMIT: "downtime_min_int > 480",
    S.SHIFT_BAD: "shift_normalized IS NULL OR shift_normalized NOT IN ('A', 'B', 'C')",
    S.LINE_MISSING: "line_normalized IS NULL",
}
_REASONS = ", ".join(f"CASE WHEN {c} THEN {_q(text)} END" for text, c in _CONDITIONS.items())
_KEYED = (
    "production_date IS NOT NULL AND shift_normalized IN ('A', 'B', 'C') "
    "AND line_normalized IS NOT NULL"
)
_KEY = _uuid(
    "CAST(production_date AS VARCHAR) || '|' || shift_normalized || '|' || line_normalized"
)
_VALIDATED_SQL = f"""
  SELECT * EXCLUDE (reasons), len(reasons) = 0 AS is_valid, reasons AS invalid_reason,
    CASE WHEN {_KEYED} THEN {_KEY} END AS shift_log_id
  FROM (SELECT *, list_sort(list_filter([{_REASONS}], lambda r: r IS NOT NULL)) AS reasons
        FROM {{flagged}})"""

_KPI_PARTS = f"""
  {_ratio("actual_output", "planned_output")} AS production_achievement,
  {_ratio("defect_qty", "actual_output")} AS defect_rate,
  {_ratio("downtime_min", "480")} AS downtime_rate"""

_STG_COLUMNS = """row_id, shift_log_id, date, shift_normalized AS shift, line_normalized AS line,
  planned_output_int AS planned_output, actual_output_int AS actual_output,
  defect_qty_int AS defect_qty, downtime_min_int AS downtime_min, downtime_reason, operator,
  source_system, is_valid, invalid_reason, is_duplicate, ingested_at, source_file, row_number,
  run_id"""


def _latest(order: str) -> str:
    return f"""SELECT * FROM stg WHERE shift_log_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY shift_log_id ORDER BY {order}) = 1"""


_LAYERS = {
    "fx": FX_SQL.format(orders="orders"),
    "norm": f"SELECT *, {_NORMALIZED} FROM fx",
    "flagged": "SELECT *, "
    + _duplicate("date, shift, line", "run_id, source_file", _RAW_USABLE)
    + " AS is_duplicate FROM norm",
    "val": _VALIDATED_SQL.format(flagged="flagged"),
    "stg": f"SELECT {_STG_COLUMNS} FROM val",
    "latest": _latest("ingested_at DESC, row_id DESC"),
    "dedup": "SELECT * FROM latest UNION ALL SELECT * FROM stg WHERE shift_log_id IS NULL",
    "kpi": f"""SELECT shift_log_id, date, shift, line, planned_output, actual_output, defect_qty,
  downtime_min, downtime_reason, operator, source_system, source_file, row_number, row_id,
  run_id, ingested_at, {_KPI_PARTS} FROM dedup WHERE is_valid""",
}


def _with(layer: str, select: str, extra: dict[str, str] | None = None) -> str:
    """The select with all layers up to ``layer`` and extra ones in front of it."""
    names = list(_LAYERS)
    parts = {name: _LAYERS[name] for name in names[: names.index(layer) + 1]} | (extra or {})
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\n{select}"


_TIME = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at"
_DATE = "CAST(production_date AS VARCHAR) AS production_date"
_REASON_TEXT = "array_to_string(invalid_reason, '; ') AS invalid_reason"


def _shown(relation: str, *replaced: str) -> str:
    return f"SELECT * REPLACE ({', '.join(replaced)}) FROM {relation}"


_SHOW_STG = _shown("{}", _TIME, _REASON_TEXT)
_SHOW_VAL = _shown("{}", _TIME, _DATE, _REASON_TEXT)

# --- marts ------------------------------------------------------------------------

_METRIC_COUNTERS = {
    "missing_id_field_rows": "missing_id_fields",
    "invalid_shift_rows": "invalid_shift",
    "missing_line_rows": "missing_line",
    **{
        f"{quantity}_{kind}_rows": f"{quantity}_{kind}"
        for quantity in ("planned_output", "actual_output", "defect_qty")
        for kind in ("missing", "parse_failed", "invalid")
    },
    "defect_exceeds_actual_rows": "defect_exceeds_actual",
    **{
        f"downtime_{kind}_rows": f"downtime_{kind}"
        for kind in ("missing", "parse_failed", "negative", "over_480")
    },
}
_FLAGS = f"""SELECT run_id, source_file, ingested_at, is_valid, is_duplicate,
  {", ".join(f"list_contains(invalid_reason, {_q(t)}) AS r_{n}" for n, t in S.METRIC_REASONS.items())}
  FROM stg"""
_METRICS = f"""SELECT run_id, source_file, MIN(ingested_at) AS run_started_at,
  MAX(ingested_at) AS run_last_seen_at, COUNT(*) AS total_rows,
  COUNT(*) FILTER (is_valid) AS rows_valid, COUNT(*) FILTER (NOT is_valid) AS rows_invalid,
  {_ratio("COUNT(*) FILTER (is_valid)", "COUNT(*)")} AS valid_rate,
  COUNT(*) FILTER (NOT r_duplicate AND NOT r_missing_id_fields) AS unique_shift_logs,
  {", ".join(f"COUNT(*) FILTER (r_{f}) AS {n}" for n, f in _METRIC_COUNTERS.items())},
  COUNT(*) FILTER (r_duplicate OR is_duplicate) AS duplicate_rows,
  {_ratio("COUNT(*) FILTER (r_duplicate OR is_duplicate)", "COUNT(*)")} AS duplicate_rate,
  {_ratio(
      "COUNT(*) FILTER (r_planned_output_parse_failed OR r_actual_output_parse_failed "
      "OR r_defect_qty_parse_failed OR r_downtime_parse_failed)", "COUNT(*)"
  )} AS numeric_parse_error_rate
  FROM flags GROUP BY run_id, source_file"""
_INVALID_REASONS = """SELECT run_id, source_file, reason AS invalid_reason, COUNT(*) AS rows_count
  FROM (SELECT run_id, source_file, unnest(invalid_reason) AS reason FROM stg)
  GROUP BY run_id, source_file, reason"""


def _kpi_by(by: str) -> str:
    return f"""SELECT {by}, COUNT(*) AS shift_count,
  {", ".join(f"{_sum(c)} AS {c}" for c in QUANTITIES)},
  {_ratio("SUM(actual_output)", "SUM(planned_output)")} AS production_achievement,
  {_ratio("SUM(defect_qty)", "SUM(actual_output)")} AS defect_rate,
  {_ratio("SUM(downtime_min)", "COUNT(*) * 480")} AS downtime_rate
  FROM kpi GROUP BY {by}"""


_SUMMARY = f"""SELECT COUNT(*) AS kpi_records, {_sum("planned_output")} AS total_planned_output,
  {_sum("actual_output")} AS total_actual_output, {_sum("defect_qty")} AS total_defects,
  {_sum("downtime_min")} AS total_downtime_min,
  {_ratio("SUM(actual_output)", "SUM(planned_output)")} AS production_achievement,
  {_ratio("SUM(defect_qty)", "SUM(actual_output)")} AS defect_rate,
  {_ratio("SUM(downtime_min)", "COUNT(*) * 480")} AS downtime_rate FROM kpi"""
_PARETO = f"""SELECT downtime_reason, total_downtime_min, round(downtime_share, 9) AS downtime_share,
  round(SUM(downtime_share) OVER (
    ORDER BY total_downtime_min DESC, downtime_reason NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS cumulative_downtime_share
  FROM (SELECT *, {_ratio("total_downtime_min", "SUM(total_downtime_min) OVER ()")} AS downtime_share
        FROM (SELECT downtime_reason, {_sum("downtime_min")} AS total_downtime_min
              FROM kpi GROUP BY downtime_reason))"""
_DRILLDOWN = """SELECT date, shift, line, planned_output, actual_output, defect_qty, downtime_min,
  downtime_reason, production_achievement, defect_rate, downtime_rate, operator, source_system,
  source_file, row_number, row_id, run_id, ingested_at FROM kpi"""

# view -> select, in dependency order; for the queries that look at all views
_VIEWS = {
    "flags": _FLAGS,
    "v_dq_metrics_by_run": _METRICS,
    "v_dq_invalid_reasons_by_run": _INVALID_REASONS,
    "v_manufacturing_kpi_summary": _SUMMARY,
    "v_manufacturing_kpi_daily_trend": _kpi_by("date"),
    "v_manufacturing_kpi_by_line": _kpi_by("line"),
    "v_manufacturing_kpi_by_shift": _kpi_by("shift"),
    "v_downtime_reason_pareto": _PARETO,
    "v_line_shift_performance": _kpi_by("line, shift"),
    "v_shift_log_kpi_drilldown": _DRILLDOWN,
}
_LAYER_OF_VIEW = {
    "stg_shift_log_validated": "stg",
    "shift_log_validated_dedup": "dedup",
    "shift_log_kpi": "kpi",
}


def _zero(ratio: str) -> str:
    return f"coalesce({ratio}, 0.0)"


_MEASURES = {
    "total_planned_output": _sum("planned_output"),
    "total_actual_output": _sum("actual_output"),
    "achievement_rate": _zero(_ratio("SUM(actual_output)", "SUM(planned_output)")),
    "defect_rate": _zero(_ratio("SUM(defect_qty)", "SUM(actual_output)")),
    "output_variance_pct": _zero(
        _ratio("(SUM(actual_output) - SUM(planned_output))", "SUM(planned_output)")
    ),
    "total_downtime_hours": _ratio("SUM(downtime_min)", "60"),
}


def _measures(*names: str, by: str = "") -> str:
    shown = ", ".join(f"{_MEASURES[n]} AS {n}" for n in names)
    return f"SELECT {by + ', ' if by else ''}{shown} FROM kpi" + (f" GROUP BY {by}" if by else "")


# --- checks -----------------------------------------------------------------------


def _null_rows(relation: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, COUNT(*) FILTER ({c} IS NULL) AS failures FROM {relation}"
        for c in cols
    )


def _repeated(relation: str, cols: str, where: str = "TRUE") -> str:
    return (
        f"SELECT {cols}, COUNT(*) AS n_rows FROM {relation} WHERE {where} "
        f"GROUP BY {cols} HAVING COUNT(*) > 1"
    )


def _accepted(relation: str, col: str) -> str:
    return (
        f"SELECT {col}, COUNT(*) AS n_rows FROM {relation} "
        f"WHERE {col} NOT IN ('A', 'B', 'C') GROUP BY {col}"
    )


def _suite_sql() -> str:
    rows = []

    def add(model: str, check: str, column: str, failures: str) -> None:
        rows.append(
            f"SELECT {_q(model)} AS model, {_q(check)} AS check_name, {_q(column)} AS column_name, "
            f"({failures}) AS failures"
        )

    for model, declared in SUITE.items():
        relation = _LAYER_OF_VIEW.get(model, model)
        for c in declared.get("not_null", ()):
            if model == "stg_shift_log_validated" and c == "production_date":
                add(model, "not_null", c, "CAST(NULL AS BIGINT)")
            else:
                add(model, "not_null", c, f"SELECT COUNT(*) FROM {relation} WHERE {c} IS NULL")
        for c in declared.get("unique", ()):
            repeated = _repeated(relation, c, f"{c} IS NOT NULL")
            add(model, "unique", c, f"SELECT COUNT(*) FROM ({repeated})")
        for c in declared.get("accepted_values", {}):
            add(model, "accepted_values", c, f"SELECT COUNT(*) FROM ({_accepted(relation, c)})")
        for cols in declared.get("unique_combination", ()):
            listed = ", ".join(cols)
            repeated = _repeated(relation, listed)
            add(model, "unique_combination", listed, f"SELECT COUNT(*) FROM ({repeated})")
    union = "\nUNION ALL ".join(rows)
    return f"""SELECT *, CASE WHEN failures IS NULL THEN 'column missing'
  WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({union})"""


# --- files ------------------------------------------------------------------------

_CHUNK = f"CAST(floor(row_number / {CHUNK}) AS BIGINT)"


def _as_csv(columns, partition: str, keep: str = "") -> str:
    """Records as a CSV file gives them back: file-order numbers, NULL as empty text."""
    texts = ", ".join(f"coalesce({c}, '') AS {c}" for c in columns)
    return (
        f"SELECT {_CHUNK} AS chunk, {keep}"
        f"row_number() OVER (PARTITION BY {partition} ORDER BY row_number) AS row_number, {texts} "
        "FROM fx"
    )


def _messy_sql() -> str:
    """What the messy files hold: the records as they were changed, and those written behind them."""
    changed = {
        "line": "CASE kind WHEN 1 THEN line || 'x\"y' WHEN 2 THEN line || ' 5\" pipe' WHEN 3 THEN 'Li\"ne' ELSE line END",
        "downtime_reason": "CASE kind WHEN 4 THEN 'two' || chr(10) || chr(10) || 'lines, \"x\"' "
        "WHEN 5 THEN 'old' || chr(13) || chr(10) || chr(13) || 'breaks' "
        "WHEN 6 THEN downtime_reason || chr(10) ELSE downtime_reason END",
    }
    own = [
        f"{changed.get(c, c)} AS {c}" if i < 4 else f"CASE WHEN kind <> 7 THEN {changed.get(c, c)} END AS {c}"
        for i, c in enumerate(SOURCE)
    ]

    def behind(kind: int, part: int, *texts: str) -> str:
        values = [f"{_q(t)} AS {c}" for c, t in zip(SOURCE, texts)]
        values += [f"CAST(NULL AS VARCHAR) AS {c}" for c in SOURCE[len(texts) :]]
        return f"SELECT chunk, rn, {part} AS part, {', '.join(values)} FROM kinds WHERE kind = {kind}"

    texts = ", ".join(f"coalesce({c}, '') AS {c}" for c in SOURCE)
    return f"""WITH kinds AS (
    SELECT {_CHUNK} AS chunk, row_number AS rn, row_number % {MESSY_KINDS} AS kind, {texts} FROM fx),
  records AS (
    SELECT chunk, rn, 0 AS part, {", ".join(own)} FROM kinds
    UNION ALL {behind(9, 1, "next", "C")}
    UNION ALL {behind(11, 1, "   ")}
    UNION ALL {behind(11, 2, 'a "b"')})
  SELECT chunk, row_number() OVER (PARTITION BY chunk ORDER BY rn, part) AS row_number, {", ".join(SOURCE)} FROM records"""


_MESSY = _messy_sql()
_LAYOUT = "CASE WHEN row_number % 2 = 0 THEN 'even' ELSE 'odd' END"
_OPTIONAL_NULL = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in S.OPTIONAL_COLUMNS)
_END_TO_END = {
    "csv": _as_csv(SOURCE, _CHUNK),
    "csvnorm": f"SELECT *, {_NORMALIZED} FROM csv",
    "csvflagged": "SELECT *, "
    + _duplicate("date, shift, line", "chunk", _RAW_USABLE)
    + " AS is_duplicate FROM csvnorm",
    "csvval": _VALIDATED_SQL.format(flagged="csvflagged"),
}

_RULE_SQL = {
    "rule_date_missing": S.DATE_MISSING,
    "rule_date_parse_failed": S.DATE_PARSE_FAILED,
    "rule_duplicate_record": S.DUPLICATE_RECORD,
    "rule_planned_output": S.PLANNED_OUTPUT_BAD,
    "rule_actual_output": S.ACTUAL_OUTPUT_BAD,
    "rule_defect_qty": S.DEFECT_QTY_BAD,
    "rule_defect_over_actual": S.DEFECT_OVER_ACTUAL,
    "rule_downtime": S.DOWNTIME_BAD,
    "rule_downtime_over_limit": S.DOWNTIME_OVER_LIMIT,
    "rule_shift": S.SHIFT_BAD,
    "rule_line_missing": S.LINE_MISSING,
}


def _rule(condition: str) -> str:
    return _with(
        "flagged",
        f"SELECT run_id, COUNT(*) FILTER ({condition}) AS n_rows FROM flagged GROUP BY run_id",
    )


def _columns(columns: str, layer: str) -> str:
    return _with(layer, f"SELECT {columns} FROM {layer}")


_REQUIRED = S.required_of(S.VALIDATED_SCHEMA)
_KPI_COLUMNS = ", ".join(S.KPI_SCHEMA.names)
_VAL_COLUMNS = ", ".join(S.VALIDATED_SCHEMA.names)
_SHARE = _ratio("defect_qty_int", "actual_output_int")
_NORMALIZED_USABLE = (
    "production_date IS NOT NULL AND shift_normalized IS NOT NULL AND line_normalized IS NOT NULL"
)



def _exported(columns, relation: str) -> str:
    """Columns as the texts of a CSV export, NULL as empty text; ratios as numbers."""
    shown = {
        "ingested_at": "strftime(ingested_at, '%Y-%m-%dT%H:%M:%SZ')",
        "invalid_reason": "'[' || array_to_string("
        "list_transform(invalid_reason, lambda r: '\"' || r || '\"'), ',') || ']'",
    }
    ratios = ("production_achievement", "defect_rate", "downtime_rate")
    parts = [
        c
        if c in ratios
        else f"coalesce({shown.get(c, f'CAST({c} AS VARCHAR)')}, '') AS {c}"
        for c in columns
    ]
    return f"SELECT {', '.join(parts)} FROM {relation}"


_TWICE = """SELECT {run} AS run_id, ingested_at, n AS raw_rows, n AS validated_rows, n AS row_ids, d AS duplicates
  FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (is_duplicate) AS d FROM csvval),
       (VALUES ('{first}'), ('{second}')) AS t(ingested_at)"""

ORACLE = {
    "strip_ws": _columns(
        "row_id, " + ", ".join(f"trim({c}) AS {c}_stripped" for c in S.REQUIRED_COLUMNS), "fx"
    ),
    "normalize_date": _columns(f"row_id, {_DATE}", "norm"),
    "normalize_shift": _columns("row_id, shift_normalized", "norm"),
    "normalize_line": _columns("row_id, line_normalized", "norm"),
    "parse_int": _columns("row_id, " + ", ".join(f"{c}_int" for c in QUANTITIES), "norm"),
    "uuid_v5": _columns(
        "row_id, " + _uuid("source_file || '|' || CAST(row_number AS VARCHAR)") + " AS name_uuid",
        "fx",
    ),
    "shift_log_id": _columns("row_id, shift_log_id", "val"),
    "safe_divide": _columns(f"row_id, {_SHARE} AS quotient", "norm"),
    "divide_or_zero": _columns(f"row_id, {_zero(_SHARE)} AS quotient", "norm"),
    "invalid_reasons_array": _columns(f"row_id, {_REASON_TEXT}", "val"),
    "normalize_records": _with("norm", _shown("norm", _TIME, _DATE)),
    "duplicate_flag": _columns("row_id, is_duplicate", "flagged"),
    "duplicate_flag_normalized": _columns(
        "row_id, "
        + _duplicate(
            "production_date, shift_normalized, line_normalized",
            "run_id, source_file",
            _NORMALIZED_USABLE,
        )
        + " AS is_duplicate",
        "norm",
    ),
    "duplicate_flag_hot": _with(
        "norm",
        "SELECT row_id, "
        + _duplicate("date, shift, line", "run_id, source_file", _RAW_USABLE).replace(
            "ORDER BY row_number", "ORDER BY row_number, row_id"
        )
        + " AS is_duplicate FROM twice",
        {"twice": "SELECT * FROM fx UNION ALL SELECT * REPLACE ('~' || row_id AS row_id) FROM fx"},
    ),
    "full_width_digits": _columns(
        f"row_id, {_DATE}, " + ", ".join(f"{c}_int" for c in QUANTITIES), "norm"
    ),
    "validate_records": _columns(
        f"row_id, is_valid, is_duplicate, {_REASON_TEXT}, shift_log_id", "val"
    ),
    "split_valid": _with("val", _SHOW_VAL.format("val") + " WHERE is_valid"),
    "split_invalid": _with("val", _SHOW_VAL.format("val") + " WHERE NOT is_valid"),
    **{name: _rule(_CONDITIONS[reason]) for name, reason in _RULE_SQL.items()},
    "rule_production_date_invalid": _rule(
        "date IS NOT NULL AND try_strptime(trim(date), '%Y-%m-%d') IS NULL"
    ),
    "stg_validated": _with("stg", _SHOW_STG.format("stg")),
    "dedup_latest": _with("latest", _SHOW_STG.format("latest")),
    "dedup_valid_first": _with(
        "stg",
        _SHOW_STG.format("best"),
        {"best": _latest("is_valid DESC, ingested_at DESC, row_id DESC")},
    ),
    "validated_dedup": _with("dedup", _SHOW_STG.format("dedup")),
    "reason_flags": _with("stg", _shown("flags", _TIME), {"flags": _FLAGS}),
    "dq_metrics_by_run": _with(
        "stg",
        _shown(
            "metrics",
            "strftime(run_started_at, '%Y-%m-%d %H:%M:%S') AS run_started_at",
            "strftime(run_last_seen_at, '%Y-%m-%d %H:%M:%S') AS run_last_seen_at",
        ),
        {"flags": _FLAGS, "metrics": _METRICS},
    ),
    "dq_invalid_reasons_by_run": _with("stg", _INVALID_REASONS),
    "shift_log_kpi": _with("kpi", _shown("kpi", _TIME)),
    "kpi_without_dedup": _with(
        "val",
        f"""SELECT * EXCLUDE (is_duplicate, invalid_reason, is_valid) REPLACE ({_TIME}, {_DATE}),
  {_ratio("actual_output_int", "planned_output_int")} AS production_achievement,
  {_ratio("defect_qty_int", "actual_output_int")} AS defect_rate,
  {_ratio("downtime_min_int", "480")} AS downtime_rate FROM val WHERE is_valid""",
    ),
    "kpi_drilldown": _with("kpi", _shown("drilldown", _TIME), {"drilldown": _DRILLDOWN}),
    "kpi_summary": _with("kpi", _SUMMARY),
    "kpi_by_line": _with("kpi", _kpi_by("line")),
    "kpi_by_shift": _with("kpi", _kpi_by("shift")),
    "kpi_daily_trend": _with("kpi", _kpi_by("date")),
    "kpi_trend_by_production_date": _with(
        "kpi",
        _shown("trend", _DATE),
        {
            "dated": f"SELECT *, CAST(try_strptime(trim(date), {_FORMATS}) AS DATE) "
            "AS production_date FROM kpi",
            "trend": _kpi_by("production_date").replace("FROM kpi", "FROM dated"),
        },
    ),
    "line_shift_performance": _with("kpi", _kpi_by("line, shift")),
    "downtime_pareto": _with("kpi", _PARETO),
    "report_measures": _with("kpi", _measures(*_MEASURES)),
    "output_variance_by_line": _with("kpi", _measures("output_variance_pct", by="line")),
    "planned_vs_actual_daily": _with(
        "kpi", _measures("total_planned_output", "total_actual_output", by="date")
    ),
    "downtime_by_reason": _with(
        "kpi",
        f"SELECT downtime_reason, {_sum('downtime_min')} AS downtime_min FROM kpi "
        "GROUP BY downtime_reason",
    ),
    "defect_rate_by_line": _with("kpi", _measures("defect_rate", by="line")),
    "report_filter_dates": _with(
        "kpi",
        f"{_shown('kpi', _TIME)} WHERE CAST(try_strptime(trim(date), {_FORMATS}) AS DATE) "
        "BETWEEN DATE '1993-01-01' AND DATE '1996-12-31'",
    ),
    "report_filter": _with(
        "kpi",
        _shown("kpi", _TIME)
        + """ WHERE run_id IN ('records_20260101T000000Z_00000000', 'records_20260103T000000Z_00000002')
  AND source_file IN ('shift_logs_0.csv', 'shift_logs_2.csv')
  AND date BETWEEN '1993-01-01' AND '1996-12-31'
  AND line IN ('Line1', 'Line3') AND shift IN ('A', 'B')""",
    ),
    "marts_all": _with(
        "kpi",
        " UNION ALL ".join(
            f"SELECT {_q(name)} AS view_name, COUNT(*) AS n_rows FROM {relation}"
            for name, relation in (
                _LAYER_OF_VIEW | {v: v for v in _VIEWS if v != "flags"}
            ).items()
        ),
        _VIEWS,
    ),
    "marts_summary": _with("kpi", _SUMMARY),
    "marts_daily_trend": _with("kpi", _kpi_by("date")),
    "marts_by_line": _with("kpi", _kpi_by("line")),
    "marts_by_shift": _with("kpi", _kpi_by("shift")),
    "marts_line_shift": _with("kpi", _kpi_by("line, shift")),
    "marts_pareto": _with("kpi", _PARETO),
    "marts_drilldown": _with("kpi", _shown("drilldown", _TIME), {"drilldown": _DRILLDOWN}),
    "check_not_null": _with(
        "stg", _null_rows("stg", ["row_id", "shift", "line", *QUANTITIES, "is_valid"])
    ),
    "check_unique": _with("stg", _repeated("stg", "shift_log_id", "shift_log_id IS NOT NULL")),
    "check_accepted_values": _with("stg", _accepted("stg", "shift")),
    "check_unique_combination": _with("stg", _repeated("stg", "date, shift, line")),
    "check_row_id_one_to_one": _with(
        "dedup",
        """SELECT row_id, CAST(SUM(r) AS BIGINT) AS raw_rows, CAST(SUM(v) AS BIGINT) AS validated_rows
  FROM (SELECT row_id, 1 AS r, 0 AS v FROM fx UNION ALL SELECT row_id, 0, 1 FROM dedup)
  GROUP BY row_id HAVING SUM(r) <> 1 OR SUM(v) <> 1""",
    ),
    "ingest_same_run_twice": _with(
        "fx",
        _TWICE.format(
            run=_q(RUN_ID),
            first=INGESTED_AT.strftime("%Y-%m-%d %H:%M:%S"),
            second=(INGESTED_AT + timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S"),
        ),
        _END_TO_END,
    ),
    "ingest_resumed": _with(
        "fx",
        _TWICE.format(
            run=_q(RUN_ID),
            first=INGESTED_AT.strftime("%Y-%m-%d %H:%M:%S"),
            second=(INGESTED_AT + timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S"),
        ),
        _END_TO_END,
    ),
    "check_raw_validated": _with(
        "fx", "SELECT 2 * COUNT(*) AS raw_rows, 0 AS failing_ids FROM fx"
    ),
    "check_suite": _with("kpi", _suite_sql(), _VIEWS),
    "required_columns": _with("val", _null_rows("val", _REQUIRED)),
    "csv_scan": _with("fx", _as_csv(SOURCE, _CHUNK)),
    "csv_scan_messy": _with("fx", "SELECT * FROM messy", {"messy": _MESSY}),
    "header_contract": _with(
        "fx", _as_csv(SOURCE, f"{_CHUNK}, row_number % 2", f"{_LAYOUT} AS layout, ")
    ),
    "fill_optional": _with(
        "fx", _as_csv(["downtime_min"], _CHUNK).replace(" FROM fx", f", {_OPTIONAL_NULL} FROM fx")
    ),
    "ingest_metadata": _with(
        "fx",
        f"SELECT chunk, row_number, {_q(RUN_ID)} AS run_id, "
        f"{_q(INGESTED_AT.strftime('%Y-%m-%d %H:%M:%S'))} AS ingested_at, 36 AS id_length, "
        f"'5' AS id_version FROM ({_as_csv(['date'], _CHUNK)})",
    ),
    "end_to_end": _with(
        "fx",
        f"SELECT chunk, row_number, {_DATE}, is_valid, is_duplicate, {_REASON_TEXT}, shift_log_id "
        "FROM csvval",
        _END_TO_END,
    ),
    "sink_raw": _with("fx", _shown("fx", _TIME)),
    "sink_validated": _with("val", f"SELECT {_VAL_COLUMNS} FROM ({_SHOW_VAL.format('val')})"),
    "sink_kpi": _with("kpi", f"SELECT {_KPI_COLUMNS} FROM ({_shown('kpi', _TIME)})"),
    "export_csv": _with(
        "val",
        f"SELECT row_id, {_DATE}, CAST(planned_output_int AS VARCHAR) AS planned_output_int, "
        "CAST(is_valid AS VARCHAR) AS is_valid, "
        "'[' || array_to_string(list_transform(invalid_reason, lambda r: '\"' || r || '\"'), ',') "
        "|| ']' AS invalid_reason, run_id FROM val",
    ),
    "sink_local": _with("fx", _exported(S.RAW_SCHEMA.names, "fx")),
    "export_validated_csv": _with("val", _exported(S.VALIDATED_SCHEMA.names, "val")),
    "export_kpi_csv": _with("kpi", _exported(S.KPI_SCHEMA.names, "kpi")),
    "write_mode": _with(
        "fx",
        "SELECT run_id, n * k AS n_rows, write_mode FROM "
        "(SELECT run_id, COUNT(*) AS n FROM fx GROUP BY run_id), "
        "(VALUES (2, 'append'), (1, 'truncate')) AS m(k, write_mode)",
    ),
}

# other ways to the same rows
ORACLE |= {
    name: ORACLE[same]
    for name, same in {
        "report_filter_stored": "report_filter_dates",
        "dedup_bucketed": "dedup_latest",
        "upkeep_dedup": "validated_dedup",
        "upkeep_kpi": "shift_log_kpi",
        "upkeep_dq_metrics": "dq_metrics_by_run",
        "upkeep_dq_reasons": "dq_invalid_reasons_by_run",
        "upkeep_summary": "kpi_summary",
        "upkeep_daily_trend": "kpi_daily_trend",
        "upkeep_by_line": "kpi_by_line",
        "upkeep_by_shift": "kpi_by_shift",
        "upkeep_line_shift": "line_shift_performance",
        "upkeep_drilldown": "kpi_drilldown",
        "upkeep_pareto": "downtime_pareto",
    }.items()
}
