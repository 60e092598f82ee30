from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shiftledger import schemas as S
from shiftledger.plans import batches, upkeep
from shiftledger.plans.batches import PARTITIONS, Batch
from shiftledger.plans.marts import build_marts
from shiftledger.plans.upkeep import held_parts, kept_up_views, latest_view, update_views
from shiftledger.sinks import write_validated
from shiftledger.sinks.buckets import latest_of_buckets, write_validated_buckets
from shiftledger.operators.dedup import dedup_latest
from shiftledger.sources.tables import TableNames, read_table

from .logs import validated_logs

AT = datetime(2033, 5, 4, 3, 2, 1, tzinfo=timezone.utc)


def changes(n, batch, months, seed):
    """Records of a batch: repeated keys, invalid and keyless ones, over some months."""
    for i in range(n):
        k = (i * 7 + seed) % 23
        yield {
            "date": None if k == 5 else f"2031-{months[k % len(months)]:02d}-{1 + k % 9:02d}" if k % 4 else f"{1 + k % 9:02d}.{months[k % len(months)]:02d}.2031",
            "shift": "ABCD"[k % 4],
            "line": f"Saw {k % 3}",
            "planned_output": "n/a" if k == 7 else str(500 + i),
            "downtime_reason": [None, "Blade", "Jam"][i % 3],
            "downtime_min": str(i % 40),
            "source_file": f"f{i % 2}.csv",
            "run_id": batch.run_id,
            "ingested_at": batch.ingested_at,
            "row_id": f"{batch.run_id}-{batch.name}-{i:04d}",
        }


def put(spark, tables, batch, rows):
    df = validated_logs(spark, *rows)
    write_validated(df, tables.validated, "partitions", partition_by=PARTITIONS)
    for layer in ("raw", "validated"):
        batches.mark(spark, tables, batch, layer, df.count())


def shown(df):
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(repr(tuple(r)) for r in df.select(*sorted(rounded, key=str)).collect())


@pytest.fixture(params=["folder", "catalog"])
def tables(spark, tmp_path, request):
    if request.param == "folder":
        yield TableNames(str(tmp_path / "store"))
        return
    spark.sql(f"CREATE DATABASE upkeep_db LOCATION '{tmp_path}/db'")
    yield TableNames("upkeep_db")
    spark.sql("DROP DATABASE upkeep_db CASCADE")


BATCHES = [Batch("r1", AT), Batch("r2", AT + timedelta(hours=1)), Batch("r1", AT - timedelta(hours=1))]


def test_batch_by_batch_equals_one_build(spark, tables):
    """The third batch is older than the others and belongs to the first run."""
    for i, (batch, months) in enumerate(zip(BATCHES, ([1, 2, 3], [3, 4], [2, 3]))):
        put(spark, tables, batch, changes(60, batch, months, i))
        assert update_views(spark, tables, parts_per_month=2) == 1
    assert update_views(spark, tables, parts_per_month=2) == 0
    built = build_marts(read_table(spark, tables.validated, S.VALIDATED_SCHEMA))
    kept = kept_up_views(spark, tables)
    assert set(kept) == set(built) - {"stg_shift_log_validated"}
    for name, df in kept.items():
        assert sorted(df.columns) == sorted(built[name].columns), name
        assert shown(df) == shown(built[name]), name


def test_several_batches_at_once(spark, tables):
    for i, batch in enumerate(BATCHES):
        put(spark, tables, batch, changes(40, batch, [1, 2], i))
    assert update_views(spark, tables) == 3
    built = build_marts(read_table(spark, tables.validated, S.VALIDATED_SCHEMA))
    for name, df in kept_up_views(spark, tables).items():
        assert shown(df) == shown(built[name]), name


def partitions_read(df):
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).selectedPartitions().partitionCount() for i in range(leaves.size()))


def test_untouched_parts_are_not_read(spark, tmp_path, monkeypatch):
    tables = TableNames(str(tmp_path / "store"))
    put(spark, tables, BATCHES[0], changes(60, BATCHES[0], [1, 2, 3, 4, 5], 0))
    update_views(spark, tables)
    before = held_parts(spark, tables).held
    opened = []
    read = upkeep._held_rows
    monkeypatch.setattr(upkeep, "_held_rows", lambda *a: opened.append(read(*a)) or opened[-1])
    put(spark, tables, BATCHES[1], changes(20, BATCHES[1], [4], 1))
    update_views(spark, tables)
    monkeypatch.undo()
    plan = opened[0]._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert partitions_read(opened[0]) == 1 and {r.month for r in opened[0].collect()} == {"2031-04"}
    after = held_parts(spark, tables).held
    assert {p for p in before - after} == {p for p in before if p[0] == "2031-04"}
    assert len({p for p in after if p[0] == upkeep.KEYLESS}) == 2
    # a quality view reads the counts of batches, not their records
    files = kept_up_views(spark, tables)["v_dq_metrics_by_run"].inputFiles()
    assert not [f for f in files if "/shift_log_validated/" in f or "/shift_log_latest/" in f]
    ranged = latest_view(spark, tables, ("2031-02-03", "2031-02-28"))
    assert partitions_read(ranged) == 3 and partitions_read(latest_view(spark, tables)) == 7
    days = {str(r.production_date) for r in ranged.collect()}
    assert days and all("2031-02-03" <= d <= "2031-02-28" for d in days)


@pytest.mark.parametrize("lost", ["kpi_partials", "latest", "metric_counts", "upkeep"])
def test_a_failed_update_changes_nothing(spark, tmp_path, monkeypatch, lost):
    tables = TableNames(str(tmp_path / "store"))
    put(spark, tables, BATCHES[0], changes(30, BATCHES[0], [1, 2], 0))
    update_views(spark, tables)
    before = shown(kept_up_views(spark, tables)["shift_log_kpi"])
    put(spark, tables, BATCHES[1], changes(30, BATCHES[1], [2], 1))
    save = upkeep.save

    def fail(df, table, *args):
        if table.endswith(lost):
            raise RuntimeError("the job is lost")
        save(df, table, *args)

    monkeypatch.setattr(upkeep, "save", fail)
    with pytest.raises(RuntimeError):
        update_views(spark, tables)
    monkeypatch.undo()
    kept = kept_up_views(spark, tables)
    assert shown(kept["shift_log_kpi"]) == before
    assert kept["v_dq_metrics_by_run"].where("run_id = 'r2'").count() == 0
    assert update_views(spark, tables) == 1
    built = build_marts(read_table(spark, tables.validated, S.VALIDATED_SCHEMA))
    for name, df in kept_up_views(spark, tables).items():
        assert shown(df) == shown(built[name]), name


def test_nothing_yet(spark, tmp_path):
    tables = TableNames(str(tmp_path / "store"))
    assert update_views(spark, tables) == 0 and held_parts(spark, tables).held == frozenset()


def test_latest_of_buckets_moves_nothing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucket_db LOCATION '{tmp_path}/db'")
    try:
        parts = [validated_logs(spark, *changes(80, b, [1, 2, 3], i)) for i, b in enumerate(BATCHES)]
        for df in parts:
            write_validated_buckets(df, "bucket_db.validated", buckets=5)
        latest = latest_of_buckets(spark, "bucket_db.validated")
        assert "Exchange" not in latest._jdf.queryExecution().executedPlan().toString()
        whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
        for first in (False, True):
            found = latest_of_buckets(spark, "bucket_db.validated", valid_first=first)
            assert found.columns == S.VALIDATED_SCHEMA.names
            assert shown(found) == shown(dedup_latest(whole, valid_first=first))
        with pytest.raises(ValueError, match="buckets take 2"):
            write_validated_buckets(whole, "bucket_db.other", buckets=5, key_rows=2)
    finally:
        spark.sql("DROP DATABASE bucket_db CASCADE")
