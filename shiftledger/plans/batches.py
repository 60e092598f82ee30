"""Batches of the raw and the validated table, and the manifest that says which are whole.

A batch is a run id with its instant of ingestion, and a partition of its own in both tables, so its rows
can be replaced without touching those of another batch. Each write of a batch ends with an entry in the
manifest: layer, batch and number of rows, counted by the write itself. An entry is one row in one
file, so it is there or it is not.

A batch without an entry for its raw rows is read from its files again, whatever a failed job has left
of it; one with raw rows only goes on from these; one with both is stored already. Readers that ask for
whole batches see none of the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .. import schemas as S
from ..sinks.tables import save
from ..sources.tables import TableNames, is_path, read_table, table_exists

PARTITIONS = ("run_id", "batch")
# fixed value: the columns of the manifest
MANIFEST_SCHEMA = "run_id string, batch string, layer string, n_rows bigint, marked_at timestamp"
#: Batches whose names are broadcast to readers at most.
BROADCAST_BATCHES = 100_000


@dataclass(frozen=True)
class Batch:
    """A run id and an instant of ingestion in whole seconds."""

    run_id: str
    ingested_at: datetime

    @property
    def name(self) -> str:
        return self.ingested_at.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def manifest(spark: SparkSession, tables: TableNames) -> DataFrame:
    """All entries; none if there is no manifest yet."""
    if not table_exists(spark, tables.batches):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    if is_path(tables.batches):
        return spark.read.schema(MANIFEST_SCHEMA).parquet(tables.batches)
    return spark.read.table(tables.batches)


def stored_rows(spark: SparkSession, tables: TableNames, batch: Batch) -> dict[str, int]:
    """Rows of the batch by layer, for the layers whose write has ended."""
    of_batch = (F.col("run_id") == batch.run_id) & (F.col("batch") == batch.name)
    entries = manifest(spark, tables).where(of_batch).groupBy("layer").agg(F.max_by("n_rows", "marked_at").alias("n_rows"))
    return {row.layer: row.n_rows for row in entries.collect()}


def forget_all(spark: SparkSession, tables: TableNames) -> None:
    """An empty manifest: until a batch is marked again, none is whole."""
    save(spark.createDataFrame([], MANIFEST_SCHEMA), tables.batches, "overwrite")


def mark(spark: SparkSession, tables: TableNames, batch: Batch, layer: str, n_rows: int) -> None:
    entry = spark.createDataFrame([(batch.run_id, batch.name, layer, n_rows)], "run_id string, batch string, layer string, n_rows bigint")
    save(entry.withColumn("marked_at", F.current_timestamp()).coalesce(1), tables.batches, "append")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """A frame that counts its rows while it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def with_batch(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows of a table with the name of their batch."""
    wide = StructType([*schema.fields]).add("batch", StringType())
    return read_table(spark, table, wide)


def read_batch(spark: SparkSession, table: str, schema: StructType, batch: Batch) -> DataFrame:
    """Rows of one batch; only its partition is opened."""
    rows = with_batch(spark, table, schema)
    return rows.where((F.col("run_id") == batch.run_id) & (F.col("batch") == batch.name)).select(*schema.names)


def whole_batches(spark: SparkSession, tables: TableNames) -> DataFrame:
    """``run_id`` and ``batch`` of the batches that are in both tables."""
    return manifest(spark, tables).where(F.col("layer") == "validated").select(*PARTITIONS).distinct()


def read_whole_batches(spark: SparkSession, tables: TableNames, layer: str = "validated") -> DataFrame:
    """Rows of all batches that are whole, without what a failed or running job has written."""
    schema = {"raw": S.RAW_SCHEMA, "validated": S.VALIDATED_SCHEMA}[layer]
    whole = whole_batches(spark, tables)
    if whole.limit(BROADCAST_BATCHES + 1).count() <= BROADCAST_BATCHES:
        whole = F.broadcast(whole)
    rows = with_batch(spark, tables.of(layer), schema)
    return rows.join(whole, list(PARTITIONS), "left_semi").select(*schema.names)
