"""Registered queries: name -> function of session and data folder."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger import schemas as S
from shiftledger.functions import (
    divide_or_zero,
    normalize_date,
    normalize_line,
    normalize_shift,
    parse_int,
    safe_divide,
    strip,
    uuid_v5,
)
from shiftledger.operators import (
    RULES,
    add_shift_log_id,
    dedup_latest,
    flag_duplicates,
    normalize_records,
    split_by_validity,
    validated_dedup,
)
from shiftledger.operators import checks
from shiftledger.plans import batches, measures, operations, quality
from shiftledger.plans.ingest import run_ingest, store_raw
from shiftledger.plans.marts import build_marts
from shiftledger.plans.staging import stg_shift_logs
from shiftledger.plans.upkeep import kept_up_views
from shiftledger.session import new_folder
from shiftledger.sinks import (
    disposition,
    export_kpi,
    export_validated,
    write_kpi,
    write_raw,
    write_validated,
)
from shiftledger.sinks.buckets import latest_of_buckets, write_validated_buckets
from shiftledger.sinks.tables import null_counts
from shiftledger.sources.shift_csv import read_shift_logs, scan_shift_logs
from shiftledger.sources.tables import TableNames, read_table

from .frames import (
    chunk_of,
    kept_up,
    kpi,
    shown,
    staged,
    stored_raw,
    stored_validated,
    validated,
    write_csv_chunks,
    write_messy_chunks,
)
from .fx import NAMESPACE, shift_logs

RUN_ID = "records_20260104T000000Z_0000000f"
INGESTED_AT = datetime(2026, 1, 4, tzinfo=timezone.utc)
SOURCE = list(S.SOURCE_COLUMNS)
REQUIRED = list(S.REQUIRED_COLUMNS)
QUANTITIES = ("planned_output", "actual_output", "defect_qty", "downtime_min")

# --- scalar functions -------------------------------------------------------------


def strip_ws(spark, sf_dir):
    return shift_logs(spark, sf_dir).select(
        "row_id", *[strip(F.col(c)).alias(f"{c}_stripped") for c in REQUIRED]
    )


def normalize_date_query(spark, sf_dir):
    return shown(
        shift_logs(spark, sf_dir).select(
            "row_id", normalize_date(F.col("date")).alias("production_date")
        )
    )


def normalize_shift_query(spark, sf_dir):
    return shift_logs(spark, sf_dir).select(
        "row_id", normalize_shift(F.col("shift")).alias("shift_normalized")
    )


def normalize_line_query(spark, sf_dir):
    return shift_logs(spark, sf_dir).select(
        "row_id", normalize_line(F.col("line")).alias("line_normalized")
    )


def parse_int_query(spark, sf_dir):
    return shift_logs(spark, sf_dir).select(
        "row_id", *[parse_int(F.col(c)).alias(f"{c}_int") for c in QUANTITIES]
    )


def uuid_v5_query(spark, sf_dir):
    name = F.concat_ws("|", "source_file", "row_number")
    return shift_logs(spark, sf_dir).select(
        "row_id", uuid_v5(NAMESPACE, name).alias("name_uuid")
    )


def shift_log_id_query(spark, sf_dir):
    keyed = add_shift_log_id(normalize_records(shift_logs(spark, sf_dir)), NAMESPACE)
    return keyed.select("row_id", "shift_log_id")


def safe_divide_query(spark, sf_dir):
    typed = normalize_records(shift_logs(spark, sf_dir))
    return typed.select(
        "row_id",
        safe_divide(F.col("defect_qty_int"), F.col("actual_output_int")).alias("quotient"),
    )


def divide_or_zero_query(spark, sf_dir):
    typed = normalize_records(shift_logs(spark, sf_dir))
    return typed.select(
        "row_id",
        divide_or_zero(F.col("defect_qty_int"), F.col("actual_output_int")).alias("quotient"),
    )


def invalid_reasons_array(spark, sf_dir):
    return shown(validated(spark, sf_dir).select("row_id", "invalid_reason"))


# --- records ----------------------------------------------------------------------


def normalize_records_query(spark, sf_dir):
    return shown(normalize_records(stored_raw(spark, sf_dir)))


def duplicate_flag(spark, sf_dir):
    return flag_duplicates(stored_raw(spark, sf_dir)).select("row_id", "is_duplicate")


def duplicate_flag_normalized(spark, sf_dir):
    """The documented variant: duplicates by normalised date, shift and line."""
    return flag_duplicates(
        normalize_records(stored_raw(spark, sf_dir)),
        keys=("production_date", "shift_normalized", "line_normalized"),
    ).select("row_id", "is_duplicate")


def duplicate_flag_hot(spark, sf_dir):
    """Every key settled by aggregation, over records that all occur twice under one number.

    Of two such records the one with the smaller id comes first.
    """
    raw = stored_raw(spark, sf_dir)
    again = raw.withColumn("row_id", F.concat(F.lit("~"), "row_id"))
    flagged = flag_duplicates(raw.unionByName(again), hot_rows=1, probe_fraction=1.0)
    return flagged.select("row_id", "is_duplicate")


def full_width_digits(spark, sf_dir):
    """Dates and quantities typed with full-width digits."""

    def wide(name):
        return F.translate(F.col(name), "0123456789", "０１２３４５６７８９")

    return shown(
        shift_logs(spark, sf_dir).select(
            "row_id",
            normalize_date(wide("date")).alias("production_date"),
            *[parse_int(wide(c)).alias(f"{c}_int") for c in QUANTITIES],
        )
    )


def validate_records_query(spark, sf_dir):
    return shown(
        validated(spark, sf_dir).select(
            "row_id", "is_valid", "is_duplicate", "invalid_reason", "shift_log_id"
        )
    )


def split_valid(spark, sf_dir):
    return shown(split_by_validity(stored_validated(spark, sf_dir))[0])


def split_invalid(spark, sf_dir):
    return shown(split_by_validity(stored_validated(spark, sf_dir))[1])


# rule queries: number of records per run that get the reason
RULE_QUERIES = {
    "rule_date_missing": S.DATE_MISSING,
    "rule_date_parse_failed": S.DATE_PARSE_FAILED,
    "rule_production_date_invalid": S.PRODUCTION_DATE_INVALID,
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


def _rule_query(reason: str):
    def query(spark, sf_dir):
        if reason == S.DUPLICATE_RECORD:
            records = flag_duplicates(stored_raw(spark, sf_dir))
        else:
            records = normalize_records(shift_logs(spark, sf_dir))
        if reason == S.PRODUCTION_DATE_INVALID:
            # the rule is for text columns, so it gets the raw text
            records = records.withColumn("production_date", strip(F.col("date")))
        return records.groupBy("run_id").agg(F.count_if(RULES[reason]()).alias("n_rows"))

    return query


# --- views ------------------------------------------------------------------------


def stg_validated(spark, sf_dir):
    return shown(staged(spark, sf_dir))


def dedup_latest_query(spark, sf_dir):
    return shown(dedup_latest(staged(spark, sf_dir)))


def dedup_valid_first(spark, sf_dir):
    return shown(dedup_latest(staged(spark, sf_dir), valid_first=True))


def validated_dedup_query(spark, sf_dir):
    return shown(validated_dedup(staged(spark, sf_dir)))


def reason_flags(spark, sf_dir):
    return shown(quality.reason_flags(staged(spark, sf_dir)))


def dq_metrics_by_run(spark, sf_dir):
    return shown(quality.dq_metrics_by_run(staged(spark, sf_dir)))


def dq_invalid_reasons_by_run(spark, sf_dir):
    return quality.dq_invalid_reasons_by_run(staged(spark, sf_dir))


def shift_log_kpi(spark, sf_dir):
    return shown(kpi(spark, sf_dir))


def kpi_without_dedup(spark, sf_dir):
    return shown(operations.kpi_without_dedup(stored_validated(spark, sf_dir)))


def _of_kpi(view):
    def query(spark, sf_dir):
        return shown(view(kpi(spark, sf_dir)))

    return query


def downtime_pareto(spark, sf_dir):
    pareto = operations.downtime_pareto(kpi(spark, sf_dir))
    return pareto.withColumns(
        {c: F.round(c, 9) for c in ("downtime_share", "cumulative_downtime_share")}
    )


def kpi_trend_by_production_date(spark, sf_dir):
    """The daily trend by true date instead of raw date text."""
    dated = kpi(spark, sf_dir).withColumn("production_date", normalize_date(F.col("date")))
    return shown(operations.kpi_daily_trend(dated, "production_date"))


def report_filter_dates(spark, sf_dir):
    """The date slicer on true dates."""
    dates, true_date = ("1993-01-01", "1996-12-31"), normalize_date(F.col("date"))
    return shown(measures.report_filter(kpi(spark, sf_dir), dates=dates, date_col=true_date))


def report_filter(spark, sf_dir):
    return shown(
        measures.report_filter(
            kpi(spark, sf_dir),
            run_ids=["records_20260101T000000Z_00000000", "records_20260103T000000Z_00000002"],
            source_files=["shift_logs_0.csv", "shift_logs_2.csv"],
            dates=("1993-01-01", "1996-12-31"),
            lines=["Line1", "Line3"],
            shifts=["A", "B"],
        )
    )


def report_filter_stored(spark, sf_dir):
    """The slicer on true dates over a table stored by month."""
    path = new_folder(spark, "kpi-by-month")
    write_kpi(kpi(spark, sf_dir), path, by_month=True)
    dates, true_date = ("1993-01-01", "1996-12-31"), normalize_date(F.col("date"))
    return shown(measures.report_filter(spark.read.parquet(path), dates=dates, date_col=true_date))


def dedup_bucketed(spark, sf_dir):
    """The latest records from a table in buckets of the key."""
    name = f"validated_buckets_{uuid.uuid4().hex}"
    path = new_folder(spark, "buckets")
    write_validated_buckets(stored_validated(spark, sf_dir), name, buckets=16, path=path)
    return shown(stg_shift_logs(latest_of_buckets(spark, name)))


def _kept_up(view):
    """A view that three updates have kept up, one for each run."""

    def query(spark, sf_dir):
        return shown(kept_up_views(spark, kept_up(spark, sf_dir))[view])

    return query


def upkeep_pareto(spark, sf_dir):
    pareto = kept_up_views(spark, kept_up(spark, sf_dir))["v_downtime_reason_pareto"]
    return pareto.withColumns(
        {c: F.round(c, 9) for c in ("downtime_share", "cumulative_downtime_share")}
    )


def _of_marts(view, *beside):
    """One view out of several built together, where groupings share a pass."""

    def query(spark, sf_dir):
        return shown(build_marts(stored_validated(spark, sf_dir), [view, *beside])[view])

    return query


def marts_pareto(spark, sf_dir):
    names = ["v_downtime_reason_pareto", "v_manufacturing_kpi_by_line"]
    pareto = build_marts(stored_validated(spark, sf_dir), names)[names[0]]
    return pareto.withColumns(
        {c: F.round(c, 9) for c in ("downtime_share", "cumulative_downtime_share")}
    )


def marts_all(spark, sf_dir):
    views = build_marts(stored_validated(spark, sf_dir))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("view_name"), "n_rows")
        for name, df in views.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


# --- checks -----------------------------------------------------------------------


def check_not_null(spark, sf_dir):
    return checks.not_null(
        staged(spark, sf_dir), ["row_id", "shift", "line", *QUANTITIES, "is_valid"]
    )


def check_unique(spark, sf_dir):
    return checks.unique(staged(spark, sf_dir), "shift_log_id")


def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(staged(spark, sf_dir), "shift", S.SHIFTS)


def check_unique_combination(spark, sf_dir):
    return checks.unique_combination(staged(spark, sf_dir), ["date", "shift", "line"])


def check_row_id_one_to_one(spark, sf_dir):
    """Raw records against the deduplicated view: every superseded record shows up."""
    return checks.row_id_one_to_one(
        stored_raw(spark, sf_dir), validated_dedup(staged(spark, sf_dir))
    )


def _ingested_twice(spark, sf_dir):
    """The names of two tables that hold two ingestions of the same files under one run id."""
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), SOURCE)
    tables = TableNames(new_folder(spark, "tables"))
    for hours in (0, 1):
        run_ingest(
            spark,
            pattern,
            tables,
            NAMESPACE,
            run_id=RUN_ID,
            ingested_at=INGESTED_AT + timedelta(hours=hours),
            source_file="path",
        )
    return tables


def ingest_same_run_twice(spark, sf_dir):
    """Per ingestion: raw and validated rows, distinct row ids, flagged rows."""
    tables = _ingested_twice(spark, sf_dir)
    raw = read_table(spark, tables.raw, S.RAW_SCHEMA)
    done = read_table(spark, tables.validated, S.VALIDATED_SCHEMA)
    counted = done.groupBy("run_id", "ingested_at").agg(
        F.count(F.lit(1)).alias("validated_rows"),
        F.count_distinct("row_id").alias("row_ids"),
        F.count_if("is_duplicate").alias("duplicates"),
    )
    read = raw.groupBy("run_id", "ingested_at").agg(F.count(F.lit(1)).alias("raw_rows"))
    return shown(read.join(counted, ["run_id", "ingested_at"], "full"))


def ingest_resumed(spark, sf_dir):
    """A batch whose job ended between its writes, another that left raw rows unmarked, both repeated."""
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), SOURCE)
    tables = TableNames(new_folder(spark, "tables"))
    halves = [batches.Batch(RUN_ID, INGESTED_AT + timedelta(hours=h)) for h in (0, 1)]
    store_raw(spark, pattern, tables, NAMESPACE, halves[0], source_file="path")
    unmarked = read_shift_logs(spark, pattern, NAMESPACE, RUN_ID, halves[1].ingested_at, "path")
    write_raw(unmarked, tables.raw, partition_by=batches.PARTITIONS)
    for half in halves:
        run_ingest(
            spark, pattern, tables, NAMESPACE, RUN_ID, ingested_at=half.ingested_at, source_file="path"
        )
    raw, done = (batches.read_whole_batches(spark, tables, layer) for layer in ("raw", "validated"))
    counted = done.groupBy("run_id", "ingested_at").agg(
        F.count(F.lit(1)).alias("validated_rows"),
        F.count_distinct("row_id").alias("row_ids"),
        F.count_if("is_duplicate").alias("duplicates"),
    )
    read = raw.groupBy("run_id", "ingested_at").agg(F.count(F.lit(1)).alias("raw_rows"))
    return shown(read.join(counted, ["run_id", "ingested_at"], "full"))


def check_raw_validated(spark, sf_dir):
    """Stored raw and validated rows of two ingestions, one to one: rows and failing row ids."""
    tables = _ingested_twice(spark, sf_dir)
    raw = read_table(spark, tables.raw, S.RAW_SCHEMA)
    failing = checks.row_id_one_to_one(raw, read_table(spark, tables.validated, S.VALIDATED_SCHEMA))
    sides = raw.select(F.lit(1).alias("r"), F.lit(0).alias("f")).unionByName(
        failing.select(F.lit(0).alias("r"), F.lit(1).alias("f"))
    )
    return sides.agg(F.sum("r").alias("raw_rows"), F.sum("f").alias("failing_ids"))


def check_suite(spark, sf_dir):
    return checks.run_checks(build_marts(stored_validated(spark, sf_dir)))


def required_columns(spark, sf_dir):
    required = S.required_of(S.VALIDATED_SCHEMA)
    counted = null_counts(stored_validated(spark, sf_dir), required)
    return counted.unpivot([], required, "column_name", "failures")


# --- files and tables -------------------------------------------------------------


def csv_scan(spark, sf_dir):
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), SOURCE)
    scanned = scan_shift_logs(spark, pattern, unique_names=False)
    return scanned.select(chunk_of("path").alias("chunk"), "row_number", *SOURCE)


def csv_scan_messy(spark, sf_dir):
    """Files with every kind of line break, text behind quotes, blank and short rows."""
    pattern = write_messy_chunks(stored_raw(spark, sf_dir), new_folder(spark, "messy"))
    scanned = scan_shift_logs(spark, pattern, unique_names=False)
    return scanned.select(chunk_of("path").alias("chunk"), "row_number", *SOURCE)


def header_contract(spark, sf_dir):
    """Files with different column orders and a column nobody expects."""
    logs = stored_raw(spark, sf_dir).withColumn("note", F.lit("ignored"))
    even = F.col("row_number") % 2 == 0
    patterns = [
        write_csv_chunks(logs.where(even), new_folder(spark, "csv-even"), SOURCE),
        write_csv_chunks(logs.where(~even), new_folder(spark, "csv-odd"), ["note", *SOURCE[::-1]]),
    ]
    scanned = scan_shift_logs(spark, patterns, unique_names=False)
    return scanned.select(
        chunk_of("path").alias("chunk"),
        F.regexp_extract("path", "csv-(even|odd)", 1).alias("layout"),
        "row_number",
        *SOURCE,
    )


def fill_optional(spark, sf_dir):
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), REQUIRED)
    scanned = scan_shift_logs(spark, pattern, unique_names=False)
    return scanned.select(
        chunk_of("path").alias("chunk"), "row_number", "downtime_min", *S.OPTIONAL_COLUMNS
    )


def ingest_metadata(spark, sf_dir):
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), SOURCE)
    raw = read_shift_logs(spark, pattern, NAMESPACE, RUN_ID, INGESTED_AT, source_file="path")
    utc = F.to_utc_timestamp("ingested_at", F.current_timezone())
    return raw.select(
        chunk_of("source_file").alias("chunk"),
        "row_number",
        "run_id",
        F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
        F.length("row_id").alias("id_length"),
        F.substring("row_id", 15, 1).alias("id_version"),
    )


def end_to_end(spark, sf_dir):
    """CSV files to raw table to validated table."""
    pattern = write_csv_chunks(stored_raw(spark, sf_dir), new_folder(spark, "csv"), SOURCE)
    stored = run_ingest(
        spark,
        pattern,
        TableNames(new_folder(spark, "tables")),
        NAMESPACE,
        run_id=RUN_ID,
        ingested_at=INGESTED_AT,
        source_file="path",
    )
    return shown(
        stored.select(
            chunk_of("source_file").alias("chunk"),
            "row_number",
            "production_date",
            "is_valid",
            "is_duplicate",
            "invalid_reason",
            "shift_log_id",
        )
    )


def sink_raw(spark, sf_dir):
    path = new_folder(spark, "raw")
    write_raw(shift_logs(spark, sf_dir), path)
    return shown(spark.read.parquet(path))


def sink_validated(spark, sf_dir):
    path = new_folder(spark, "validated")
    write_validated(validated(spark, sf_dir), path)
    return shown(spark.read.parquet(path))


def sink_kpi(spark, sf_dir):
    path = new_folder(spark, "kpi")
    write_kpi(kpi(spark, sf_dir), path)
    return shown(spark.read.parquet(path))


def export_csv(spark, sf_dir):
    path = export_validated(
        stored_validated(spark, sf_dir), new_folder(spark, "export"), "shift_logs.csv"
    )
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(
        "row_id", "production_date", "planned_output_int", "is_valid", "invalid_reason", "run_id"
    )


def _read_back(spark, path, schema):
    """An export read by position of its header, every column as text."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    back = reader.option("enforceSchema", False).csv(path, ", ".join(f"`{c}` string" for c in schema.names))
    return back.withColumns({c: F.coalesce(c, F.lit("")) for c in schema.names})


def sink_local(spark, sf_dir):
    """All columns of the raw layer, written as a CSV export through the destination setting."""
    path = new_folder(spark, "raw-export")
    write_raw(stored_raw(spark, sf_dir), path, dest="local")
    return _read_back(spark, path, S.RAW_SCHEMA)


def export_validated_csv(spark, sf_dir):
    """All columns of the validated layer."""
    folder = new_folder(spark, "export")
    path = export_validated(stored_validated(spark, sf_dir), folder, "shift_logs.csv")
    return _read_back(spark, path, S.VALIDATED_SCHEMA)


def export_kpi_csv(spark, sf_dir):
    """All columns of the KPI layer; the ratios go back to numbers."""
    path = export_kpi(kpi(spark, sf_dir), new_folder(spark, "export"), "shift_logs.csv")
    ratios = ("production_achievement", "defect_rate", "downtime_rate")
    return _read_back(spark, path, S.KPI_SCHEMA).withColumns(
        {c: F.expr(f"try_cast({c} AS double)") for c in ratios}
    )


def write_mode(spark, sf_dir):
    """Rows in a table after two appends and after a replacing write."""
    logs = shift_logs(spark, sf_dir)
    results = []
    for setting in ("append", "truncate"):
        path = new_folder(spark, setting)
        for _ in range(2):
            write_raw(logs, path, disposition(setting))
        results.append(
            spark.read.parquet(path)
            .groupBy("run_id")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("write_mode", F.lit(setting))
        )
    return results[0].unionByName(results[1])


QUERIES = {
    "strip_ws": strip_ws,
    "normalize_date": normalize_date_query,
    "normalize_shift": normalize_shift_query,
    "normalize_line": normalize_line_query,
    "parse_int": parse_int_query,
    "uuid_v5": uuid_v5_query,
    "shift_log_id": shift_log_id_query,
    "safe_divide": safe_divide_query,
    "divide_or_zero": divide_or_zero_query,
    "invalid_reasons_array": invalid_reasons_array,
    "normalize_records": normalize_records_query,
    "duplicate_flag": duplicate_flag,
    "duplicate_flag_normalized": duplicate_flag_normalized,
    "duplicate_flag_hot": duplicate_flag_hot,
    "full_width_digits": full_width_digits,
    "validate_records": validate_records_query,
    "split_valid": split_valid,
    "split_invalid": split_invalid,
    **{name: _rule_query(reason) for name, reason in RULE_QUERIES.items()},
    "stg_validated": stg_validated,
    "dedup_latest": dedup_latest_query,
    "dedup_valid_first": dedup_valid_first,
    "validated_dedup": validated_dedup_query,
    "reason_flags": reason_flags,
    "dq_metrics_by_run": dq_metrics_by_run,
    "dq_invalid_reasons_by_run": dq_invalid_reasons_by_run,
    "shift_log_kpi": shift_log_kpi,
    "kpi_without_dedup": kpi_without_dedup,
    "kpi_drilldown": _of_kpi(operations.kpi_drilldown),
    "kpi_summary": _of_kpi(operations.kpi_summary),
    "kpi_by_line": _of_kpi(operations.kpi_by_line),
    "kpi_by_shift": _of_kpi(operations.kpi_by_shift),
    "kpi_daily_trend": _of_kpi(operations.kpi_daily_trend),
    "kpi_trend_by_production_date": kpi_trend_by_production_date,
    "line_shift_performance": _of_kpi(operations.line_shift_performance),
    "downtime_pareto": downtime_pareto,
    "report_measures": _of_kpi(measures.report_measures),
    "output_variance_by_line": _of_kpi(measures.output_variance_by_line),
    "planned_vs_actual_daily": _of_kpi(measures.planned_vs_actual_daily),
    "downtime_by_reason": _of_kpi(measures.downtime_by_reason),
    "defect_rate_by_line": _of_kpi(measures.defect_rate_by_line),
    "report_filter": report_filter,
    "report_filter_dates": report_filter_dates,
    "report_filter_stored": report_filter_stored,
    "dedup_bucketed": dedup_bucketed,
    "upkeep_dedup": _kept_up("shift_log_validated_dedup"),
    "upkeep_kpi": _kept_up("shift_log_kpi"),
    "upkeep_dq_metrics": _kept_up("v_dq_metrics_by_run"),
    "upkeep_dq_reasons": _kept_up("v_dq_invalid_reasons_by_run"),
    "upkeep_summary": _kept_up("v_manufacturing_kpi_summary"),
    "upkeep_daily_trend": _kept_up("v_manufacturing_kpi_daily_trend"),
    "upkeep_by_line": _kept_up("v_manufacturing_kpi_by_line"),
    "upkeep_by_shift": _kept_up("v_manufacturing_kpi_by_shift"),
    "upkeep_line_shift": _kept_up("v_line_shift_performance"),
    "upkeep_drilldown": _kept_up("v_shift_log_kpi_drilldown"),
    "upkeep_pareto": upkeep_pareto,
    "marts_all": marts_all,
    "marts_summary": _of_marts("v_manufacturing_kpi_summary", "v_manufacturing_kpi_by_line"),
    "marts_daily_trend": _of_marts("v_manufacturing_kpi_daily_trend", "v_manufacturing_kpi_by_line"),
    "marts_by_line": _of_marts("v_manufacturing_kpi_by_line", "v_manufacturing_kpi_by_shift"),
    "marts_by_shift": _of_marts("v_manufacturing_kpi_by_shift", "v_manufacturing_kpi_by_line"),
    "marts_line_shift": _of_marts("v_line_shift_performance", "v_manufacturing_kpi_by_line"),
    "marts_pareto": marts_pareto,
    "marts_drilldown": _of_marts("v_shift_log_kpi_drilldown", "v_manufacturing_kpi_by_line"),
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted_values": check_accepted_values,
    "check_unique_combination": check_unique_combination,
    "check_row_id_one_to_one": check_row_id_one_to_one,
    "ingest_same_run_twice": ingest_same_run_twice,
    "ingest_resumed": ingest_resumed,
    "check_raw_validated": check_raw_validated,
    "check_suite": check_suite,
    "required_columns": required_columns,
    "csv_scan": csv_scan,
    "csv_scan_messy": csv_scan_messy,
    "header_contract": header_contract,
    "fill_optional": fill_optional,
    "ingest_metadata": ingest_metadata,
    "end_to_end": end_to_end,
    "sink_raw": sink_raw,
    "sink_validated": sink_validated,
    "sink_kpi": sink_kpi,
    "export_csv": export_csv,
    "sink_local": sink_local,
    "export_validated_csv": export_validated_csv,
    "export_kpi_csv": export_kpi_csv,
    "write_mode": write_mode,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI by production line, from raw records."""
    return QUERIES["kpi_by_line"](spark, sf_dir)
