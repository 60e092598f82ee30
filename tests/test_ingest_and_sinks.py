import csv
import glob
import json
from datetime import datetime, timezone

import pytest

from shiftledger import schemas as S
from shiftledger.operators import checks
from shiftledger.plans.ingest import run_ingest
from shiftledger.plans.operations import kpi_of_staged
from shiftledger.plans.staging import stg_shift_logs
from shiftledger.sinks import (
    disposition,
    export_kpi,
    export_raw,
    export_validated,
    require_not_null,
    write_kpi,
    write_raw,
    write_validated,
)
from shiftledger.sources.tables import TableNames, read_table

from .logs import NAMESPACE, by_row, raw_logs, staged_logs, validated_logs

HEADER = ",".join(S.SOURCE_COLUMNS)


def test_table_names():
    names = TableNames("cat.db")
    assert (names.raw, names.validated, names.kpi) == (
        "cat.db.shift_log_raw",
        "cat.db.shift_log_validated",
        "cat.db.shift_log_kpi",
    )
    assert TableNames("/data/x/", "plant").raw == "/data/x/plant_raw"
    prod = TableNames("p.raw", target="prod", targets=(("dev", "p.dev"), ("prod", "p.prod")))
    assert prod.validated_dedup == "p.prod.shift_log_validated_dedup" and prod.raw == "p.raw.shift_log_raw"
    with pytest.raises(ValueError, match="build target"):
        TableNames("b", target="x", targets=(("dev", "d"),)).validated_dedup


def test_ingest_end_to_end(spark, tmp_path):
    path = tmp_path / "log.csv"
    rows = [
        "2031-11-07,C,Saw 4,640,512,7,33,Blade change,Okafor,Tablet",
        "2031-11-07,C,Saw 4,640,512,7,33,Blade change,Okafor,Second upload",
        "07.11.2031, b ,Saw 4,1_000,95,96,481,,Okafor,",
    ]
    path.write_text(HEADER + "\n" + "\n".join(rows) + "\n")
    tables = TableNames(str(tmp_path / "store"))
    for run in ("r1", "r2"):
        at = datetime(2026, 1, 6 if run == "r1" else 7, tzinfo=timezone.utc)
        validated = run_ingest(spark, str(path), tables, NAMESPACE, run_id=run, ingested_at=at)
        assert validated.columns == S.VALIDATED_SCHEMA.names
        got = validated.orderBy("row_number").select("is_valid", "is_duplicate", "invalid_reason")
        assert [tuple(r) for r in got.collect()] == [
            (True, False, []),
            (False, True, [S.DUPLICATE_RECORD]),
            (False, False, [S.DEFECT_OVER_ACTUAL, S.DOWNTIME_OVER_LIMIT]),
        ]
    raw, stored = read_table(spark, tables.raw), read_table(spark, tables.validated)
    assert raw.count() == stored.count() == 6
    assert checks.row_id_one_to_one(raw, stored).count() == 0
    assert raw.where("downtime_reason = ''").count() == 2
    # the newer run wins
    latest = kpi_of_staged(stg_shift_logs(stored)).collect()
    assert {r.run_id for r in latest} <= {"r2"}
    # the instant of the call has microseconds, the stored one whole seconds
    again = run_ingest(spark, str(path), tables, NAMESPACE, run_id="r3", mode="overwrite")
    assert again.count() == 3 and read_table(spark, tables.raw).count() == 3


def test_one_run_ingested_twice(spark, tmp_path):
    """A run id that looks like a number, used for two batches; a stored batch is refused."""
    path = tmp_path / "log.csv"
    path.write_text(HEADER + "\n" + "2031-11-07,C,Saw 4,640,512,7,33,Blade change,Okafor,Tablet\n" * 2)
    tables = TableNames(str(tmp_path / "store"))
    for day in (6, 7):
        at = datetime(2032, 1, day, tzinfo=timezone.utc)
        batch = run_ingest(spark, str(path), tables, NAMESPACE, run_id="0042", ingested_at=at)
        assert by_row(batch, "run_id", "is_duplicate") == [("0042", False), ("0042", True)]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "(run_id#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    raw, stored = (read_table(spark, t, s) for t, s in ((tables.raw, S.RAW_SCHEMA), (tables.validated, S.VALIDATED_SCHEMA)))
    assert raw.count() == stored.count() == 4 and checks.row_id_one_to_one(raw, stored).count() == 0
    with pytest.raises(ValueError, match="stored already: 0042"):
        run_ingest(spark, str(path), tables, NAMESPACE, run_id="0042", ingested_at=at)
    assert read_table(spark, tables.raw).count() == 4


def test_exports_of_several_inputs_need_a_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n2031-11-07,C,Saw 4,640,512,7,33,,Okafor,Tablet\n")
    out = TableNames(str(tmp_path / "out"))
    with pytest.raises(ValueError, match="export_name"):
        run_ingest(spark, f"{tmp_path}/*.csv", out, NAMESPACE, dest="local")
    run_ingest(spark, f"{tmp_path}/*.csv", out, NAMESPACE, dest="local", export_name="mill")
    assert len(read_export(tmp_path / "out" / "mill_validated")) == 1


def test_ingest_to_csv(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(HEADER + "\n2031-11-07,C,Saw 4,640,512,7,33,Blade change,Okafor,Tablet\n")
    out = TableNames(str(tmp_path / "out"))
    validated = run_ingest(spark, str(path), out, NAMESPACE, run_id="r", dest="local")
    assert validated.count() == 1
    raw, checked = (read_export(tmp_path / "out" / f"log_{x}") for x in ("raw", "validated"))
    assert raw[0]["row_id"] == checked[0]["row_id"]
    assert (checked[0]["is_valid"], checked[0]["invalid_reason"]) == ("true", "[]")
    with pytest.raises(ValueError, match="unknown destination"):
        run_ingest(spark, str(path), out, NAMESPACE, dest="cloud")


def test_truncate_and_append(spark, tmp_path):
    assert (disposition("truncate"), disposition("append"), disposition(None)) == (
        "overwrite",
        "append",
        "append",
    )
    raw, path = raw_logs(spark, {}, {}), str(tmp_path / "t")
    for mode, rows in (("append", 2), ("append", 4), ("overwrite", 2)):
        write_raw(raw, path, mode)
        assert spark.read.parquet(path).count() == rows
    with pytest.raises(ValueError, match="write mode"):
        write_raw(raw, path, "replace")


def test_schemas_of_stored_tables(spark, tmp_path):
    validated = validated_logs(spark, {}, {"line": "L2"}, {"line": ""})
    write_validated(validated, str(tmp_path / "v"))
    back = spark.read.parquet(str(tmp_path / "v"))
    assert [(f.name, f.dataType.typeName()) for f in back.schema] == [
        (f.name, f.dataType.typeName()) for f in S.VALIDATED_SCHEMA
    ]
    write_kpi(kpi_of_staged(stg_shift_logs(validated)), str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).columns == S.KPI_SCHEMA.names


def test_clusterings(spark, tmp_path):
    validated = validated_logs(spark, *[{"line": f"L{i % 50}", "date": None if i % 3 else "2026-01-05"} for i in range(300)])
    seen = []
    for cluster in ("local", "range"):
        path = str(tmp_path / cluster)
        write_validated(validated, path, cluster=cluster)
        seen.append(sorted(map(str, spark.read.parquet(path).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 300
    with pytest.raises(ValueError, match="clustering"):
        write_validated(validated, str(tmp_path / "x"), cluster="zone")


def test_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS logs_db LOCATION '{tmp_path}/db'")
    try:
        write_raw(raw_logs(spark, {}), "logs_db.shift_log_raw")
        write_raw(raw_logs(spark, {}), "logs_db.shift_log_raw")
        assert read_table(spark, "logs_db.shift_log_raw").count() == 2
    finally:
        spark.sql("DROP DATABASE logs_db CASCADE")


def test_required_columns(spark, tmp_path):
    raw = raw_logs(spark, {}, {"date": None})
    require_not_null(raw, S.required_of(S.RAW_SCHEMA))
    with pytest.raises(ValueError, match="'date': 1"):
        require_not_null(raw, ["date", "shift"])
    from pyspark.sql import functions as F

    broken = raw.withColumn("run_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="required column holds NULL: run_id"):
        write_raw(broken, str(tmp_path / "broken"))


def test_unknown_destination(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown destination 'cloud'"):
        write_validated(validated_logs(spark, {}), str(tmp_path / "x"), dest="cloud")


def read_export(folder):
    rows = []
    for part in sorted(glob.glob(f"{folder}/*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    return rows


def test_csv_exports(spark, tmp_path):
    changes = ({"operator": 'J "x", y', "downtime_reason": "  two\nlines "}, {"shift": "D", "line": None})
    path = export_validated(validated_logs(spark, *changes), str(tmp_path), "in/log.csv")
    assert path == f"{tmp_path}/log_validated"
    rows = sorted(read_export(path), key=lambda r: int(r["row_number"]))
    assert list(rows[0]) == S.VALIDATED_SCHEMA.names
    assert rows[0]["operator"] == 'J "x", y' and rows[0]["downtime_reason"] == "  two\nlines "
    assert rows[0]["ingested_at"] == "2026-01-05T00:00:00Z"
    assert json.loads(rows[1]["invalid_reason"]) == [S.LINE_MISSING, S.SHIFT_BAD]
    raw = export_raw(raw_logs(spark, *changes), str(tmp_path), "log.csv")
    assert list(read_export(raw)[0]) == S.RAW_SCHEMA.names
    kpi = export_kpi(kpi_of_staged(staged_logs(spark, {})), str(tmp_path), "log.csv")
    assert list(read_export(kpi)[0]) == S.KPI_SCHEMA.names
    again = export_kpi(kpi_of_staged(staged_logs(spark, {})), str(tmp_path), "log.csv")
    assert len(read_export(again)) == 1
    write_raw(raw_logs(spark, {}), str(tmp_path / "local"), dest="local")
    assert len(read_export(tmp_path / "local")) == 1
