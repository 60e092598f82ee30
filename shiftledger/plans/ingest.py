"""From CSV files to the validated table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..operators.validate import validate_records
from ..session import stage
from ..sinks.csv_export import export_raw, export_validated
from ..sinks.tables import DESTINATIONS, write_raw, write_validated
from ..sources.shift_csv import batch_instant, make_run_id, read_shift_logs
from ..sources.tables import TableNames
from .batches import PARTITIONS, Batch, counted, forget_all, mark, read_batch, stored_rows


def _single_input(paths: str | Sequence[str]) -> str:
    """The one file that exports can be named after."""
    named = [paths] if isinstance(paths, str) else list(paths)
    if len(named) != 1 or any(sign in named[0] for sign in "*?{["):
        raise ValueError("export_name is needed for patterns and for several inputs")
    return named[0]


def run_ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    tables: TableNames,
    namespace: str | uuid.UUID,
    run_id: str | None = None,
    mode: str = "append",
    ingested_at: datetime | None = None,
    source_file: str = "name",
    dest: str = "table",
    export_name: str | None = None,
    **duplicate_options,
) -> DataFrame:
    """Ingest files as one batch and return the validated records of that batch.

    A batch is a run id together with its instant of ingestion in whole seconds, so a run id
    that is used again neither validates nor flags the rows of an earlier ingestion. A batch
    that is stored already is refused unless ``mode`` replaces the tables. One whose earlier job
    failed is repeated by the same call: it goes on from the raw rows if they are whole, without
    reading the files, and replaces what was left of the batch otherwise.

    The raw table is written first and read back, so both tables hold the same rows and the
    later steps scan columns instead of parsing text again. Both tables are partitioned by run
    id and batch: reading a batch back opens its files and no others. With ``dest="local"``
    both layers become CSV exports in the folder ``tables.base``, named after ``export_name``
    or after the input, if that is a single path without a pattern.
    """
    if dest not in DESTINATIONS:
        raise ValueError(f"unknown destination {dest!r}, expected one of {DESTINATIONS}")
    run_id = run_id or make_run_id()
    ingested_at = batch_instant(ingested_at or datetime.now(timezone.utc))
    duplicate_options.setdefault("scope", ("run_id", "ingested_at", "source_file"))
    if dest == "local":
        name = export_name or _single_input(paths)
        raw = stage(read_shift_logs(spark, paths, namespace, run_id, ingested_at, source_file), "raw")
        validated = stage(validate_records(raw, namespace, **duplicate_options), "validated")
        export_raw(raw, tables.base, name)
        export_validated(validated, tables.base, name)
        return validated
    batch = Batch(run_id, ingested_at)
    stored = {} if mode == "overwrite" else stored_rows(spark, tables, batch)
    if "validated" in stored:
        raise ValueError(f"batch is stored already: {run_id} at {ingested_at.isoformat()}")
    if "raw" not in stored:
        store_raw(spark, paths, tables, namespace, batch, mode, source_file)
    store_validated(spark, tables, namespace, batch, mode, **duplicate_options)
    return read_batch(spark, tables.validated, S.VALIDATED_SCHEMA, batch)


def _batch_mode(mode: str) -> str:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode: {mode}")
    return "overwrite" if mode == "overwrite" else "partitions"


def store_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    tables: TableNames,
    namespace: str | uuid.UUID,
    batch: Batch,
    mode: str = "append",
    source_file: str = "name",
) -> None:
    """First step: the raw rows of a batch, in place of any that a failed job has left."""
    raw, seen = counted(read_shift_logs(spark, paths, namespace, batch.run_id, batch.ingested_at, source_file))
    if mode == "overwrite":
        forget_all(spark, tables)
    write_raw(raw, tables.raw, _batch_mode(mode), partition_by=PARTITIONS)
    mark(spark, tables, batch, "raw", seen.get["n_rows"])


def store_validated(
    spark: SparkSession,
    tables: TableNames,
    namespace: str | uuid.UUID,
    batch: Batch,
    mode: str = "append",
    **duplicate_options,
) -> None:
    """Second step: the validated rows of a batch, one for each of its marked raw rows.

    Raw rows lost or added since they were marked are an error.
    """
    raw = read_batch(spark, tables.raw, S.RAW_SCHEMA, batch)
    marked, found = stored_rows(spark, tables, batch).get("raw"), raw.count()
    if found != marked:
        raise ValueError(f"batch {batch.run_id} {batch.name} has {found} raw rows, {marked} are marked")
    checked = validate_records(raw, namespace, **duplicate_options)
    write_validated(checked, tables.validated, _batch_mode(mode), partition_by=PARTITIONS)
    mark(spark, tables, batch, "validated", found)
