from datetime import datetime, timezone

import pytest

from shiftledger import schemas as S
from shiftledger.plans import batches, ingest
from shiftledger.plans.batches import Batch, read_whole_batches
from shiftledger.plans.ingest import run_ingest
from shiftledger.sinks import write_raw
from shiftledger.sources.tables import TableNames, read_table

from .logs import NAMESPACE, raw_logs

HEADER = ",".join(S.SOURCE_COLUMNS)
AT = datetime(2033, 5, 4, 3, 2, 1, tzinfo=timezone.utc)


@pytest.fixture(params=["folder", "catalog"])
def tables(spark, tmp_path, request):
    if request.param == "folder":
        yield TableNames(str(tmp_path / "store"))
        return
    spark.sql(f"CREATE DATABASE batch_db LOCATION '{tmp_path}/db'")
    yield TableNames("batch_db")
    spark.sql("DROP DATABASE batch_db CASCADE")


@pytest.fixture
def log(tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(HEADER + "\n" + "2031-11-07,C,Saw 4,640,512,7,33,Blade change,Okafor,Tablet\n" * 3)
    return str(path)


def rows(spark, tables, layer):
    return read_whole_batches(spark, tables, layer).count()


def test_failure_between_the_writes(spark, tables, log, monkeypatch):
    run_ingest(spark, log, tables, NAMESPACE, "r1", ingested_at=AT)

    def fail(*args, **kwargs):
        raise RuntimeError("the job is lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_validated", fail)
        with pytest.raises(RuntimeError, match="lost"):
            run_ingest(spark, log, tables, NAMESPACE, "r2", ingested_at=AT)
    # the half of a batch is in its table, but not for readers of whole batches
    assert read_table(spark, tables.raw, S.RAW_SCHEMA).count() == 6
    assert (rows(spark, tables, "raw"), rows(spark, tables, "validated")) == (3, 3)
    with monkeypatch.context() as m:
        m.setattr(ingest, "read_shift_logs", fail)  # the files are not read again
        again = run_ingest(spark, log, tables, NAMESPACE, "r2", ingested_at=AT)
        assert sorted(r.is_duplicate for r in again.collect()) == [False, True, True]
    assert (rows(spark, tables, "raw"), rows(spark, tables, "validated")) == (6, 6)
    with pytest.raises(ValueError, match="stored already: r2"):
        run_ingest(spark, log, tables, NAMESPACE, "r2", ingested_at=AT)


def test_failure_in_the_first_write(spark, tables, log, monkeypatch):
    """Rows that a lost job has left are replaced, those of other batches stay."""
    run_ingest(spark, log, tables, NAMESPACE, "r1", ingested_at=AT)
    left = raw_logs(spark, {"run_id": "r2", "ingested_at": AT}, {"run_id": "r2", "ingested_at": AT})
    write_raw(left, tables.raw, "partitions", partition_by=batches.PARTITIONS)
    assert read_table(spark, tables.raw, S.RAW_SCHEMA).count() == 5
    run_ingest(spark, log, tables, NAMESPACE, "r2", ingested_at=AT)
    assert read_table(spark, tables.raw, S.RAW_SCHEMA).count() == 6
    assert {r.source_file for r in read_table(spark, tables.raw, S.RAW_SCHEMA).collect()} == {"log.csv"}


def test_replacing_the_tables_forgets_their_batches(spark, tables, log, monkeypatch):
    run_ingest(spark, log, tables, NAMESPACE, "r1", ingested_at=AT)

    def fail(*args, **kwargs):
        raise RuntimeError("the job is lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_validated", fail)
        with pytest.raises(RuntimeError):
            run_ingest(spark, log, tables, NAMESPACE, "r2", "overwrite", AT)
    assert rows(spark, tables, "validated") == 0
    run_ingest(spark, log, tables, NAMESPACE, "r2", "overwrite", AT)
    assert rows(spark, tables, "validated") == read_table(spark, tables.validated).count() == 3


def test_lost_raw_rows_are_an_error(spark, tables, log):
    batch = Batch("r1", AT)
    ingest.store_raw(spark, log, tables, NAMESPACE, batch)
    batches.mark(spark, tables, batch, "raw", 7)
    with pytest.raises(ValueError, match="has 3 raw rows, 7 are marked"):
        run_ingest(spark, log, tables, NAMESPACE, "r1", ingested_at=AT)


def test_only_whole_batches_are_opened(spark, tmp_path, log):
    tables = TableNames(str(tmp_path / "store"))
    for run in ("r1", "r2"):
        run_ingest(spark, log, tables, NAMESPACE, run, ingested_at=AT)
    df = read_whole_batches(spark, tables)
    assert df.columns == S.VALIDATED_SCHEMA.names and df.count() == 6
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "CartesianProduct" not in plan
    one = batches.read_batch(spark, tables.raw, S.RAW_SCHEMA, Batch("r2", AT))
    filters = one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert "run_id#" in filters and "batch#" in filters
    assert batches.manifest(spark, TableNames(str(tmp_path / "none"))).count() == 0
