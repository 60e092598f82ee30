"""Layers the registered queries read, and result columns both engines can compare."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, TimestampType

from shiftledger import schemas as S
from shiftledger.operators import validate_records
from shiftledger.plans import batches
from shiftledger.plans.operations import kpi_of_staged
from shiftledger.plans.staging import stg_shift_logs
from shiftledger.plans.upkeep import update_views
from shiftledger.session import new_folder
from shiftledger.sinks import write_raw, write_validated
from shiftledger.sinks.tables import batch_name
from shiftledger.sources.tables import TableNames

from .fx import NAMESPACE, shift_logs

# rows of one CSV file of the file queries, in units of row_number
CHUNK = 15_000

_tables: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, layer: str, write: Callable[[str], None]) -> DataFrame:
    """A table written once per session: later steps read a table, not the chain behind it."""
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _tables:
        path = new_folder(spark, layer)
        write(path)
        _tables[key] = path
    return spark.read.parquet(_tables[key])


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table over all shift logs."""
    return _stored(spark, sf_dir, "raw", lambda p: write_raw(shift_logs(spark, sf_dir), p))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw records validated, as an unstored plan."""
    return validate_records(stored_raw(spark, sf_dir), NAMESPACE)


def stored_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validated table, clustered for deduplication."""
    return _stored(
        spark, sf_dir, "validated", lambda p: write_validated(validated(spark, sf_dir), p)
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_shift_logs(stored_validated(spark, sf_dir))


def kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_of_staged(staged(spark, sf_dir))


_kept: dict[tuple[str, str], TableNames] = {}


def kept_up(spark: SparkSession, sf_dir: str) -> TableNames:
    """Tables whose views have been brought up to date after each run, one batch a run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _kept:
        tables = TableNames(new_folder(spark, "kept"))
        records = stored_validated(spark, sf_dir)
        runs = records.select("run_id", "ingested_at").distinct().orderBy("run_id").collect()
        for run_id, instant in runs:
            of_run = records.where((F.col("run_id") == run_id) & (F.col("ingested_at") == F.lit(instant)))
            write_validated(of_run, tables.validated, "partitions", partition_by=batches.PARTITIONS)
            batch = of_run.select(batch_name(F.col("ingested_at"))).first()[0]
            at = datetime.strptime(batch, "%Y%m%dT%H%M%SZ").replace(tzinfo=timezone.utc)
            batches.mark(spark, tables, batches.Batch(run_id, at), "validated", of_run.count())
            update_views(spark, tables)
        _kept[key] = tables
    return _kept[key]


def shown(df: DataFrame) -> DataFrame:
    """Instants and dates as text, arrays joined by ``"; "``."""

    def column(field):
        value = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, ArrayType):
            value = F.concat_ws("; ", value)
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def write_csv_chunks(df: DataFrame, folder: str, columns: list[str]) -> str:
    """Write one CSV file per chunk of row numbers, in row order, and return their pattern.

    The number of files grows with the data; each holds about five thousand rows.
    """
    (
        df.withColumn("chunk", F.floor(F.col("row_number") / CHUNK))
        .repartition("chunk")
        .sortWithinPartitions("chunk", "row_number")
        .select(*columns, "chunk")
        .write.partitionBy("chunk")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return f"{folder}/chunk=*/*.csv"


# what is done to a record of the messy files, by its row number modulo this many kinds
MESSY_KINDS = 12


def write_messy_chunks(df: DataFrame, folder: str) -> str:
    """One hand-made looking CSV file per chunk of row numbers, and their pattern.

    Written as text, so that every sign is ours; ``csv_scan_messy`` says in SQL what has to be read.
    """
    kind = F.col("row_number") % MESSY_KINDS
    text = {c: F.coalesce(c, F.lit("")) for c in S.SOURCE_COLUMNS}
    text["line"] = (
        F.when(kind == 1, F.concat(F.lit('"'), text["line"], F.lit('"x"y')))
        .when(kind == 2, F.concat(text["line"], F.lit(' 5" pipe')))
        .when(kind == 3, F.lit('"Li""ne"'))
        .otherwise(text["line"])
    )
    text["downtime_reason"] = (
        F.when(kind == 4, F.lit('"two\n\nlines, ""x"""'))
        .when(kind == 5, F.lit('"old\r\n\rbreaks"'))
        .when(kind == 6, F.concat(F.lit('"'), text["downtime_reason"], F.lit('\n"')))
        .otherwise(text["downtime_reason"])
    )
    whole = F.concat_ws(",", *text.values())
    record = (
        F.when(kind == 7, F.concat_ws(",", *list(text.values())[:4]))
        .when(kind == 8, F.concat(whole, F.lit("\r")))
        .when(kind == 9, F.concat(whole, F.lit("\rnext,C\r")))
        .when(kind == 10, F.concat(whole, F.lit("\n\n\r\n")))
        .when(kind == 11, F.concat(whole, F.lit('\n   \n"a ""b"""')))
        .otherwise(whole)
    )
    chunk = F.floor(F.col("row_number") / CHUNK).alias("chunk")
    records = df.select(chunk, "row_number", record.alias("value"))
    headers = records.select("chunk", F.lit(-1).cast("bigint"), F.lit(",".join(S.SOURCE_COLUMNS))).distinct()
    (
        records.unionAll(headers)
        .repartition("chunk")
        .sortWithinPartitions("chunk", "row_number")
        .select("value", "chunk")
        .write.partitionBy("chunk")
        .text(folder)
    )
    # the text writer names its files .txt
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(context._jsc.hadoopConfiguration())
    for status in system.globStatus(path(f"{folder}/chunk=*/*.txt")):
        written = status.getPath().toString()
        system.rename(status.getPath(), path(written.removesuffix("txt") + "csv"))
    return f"{folder}/chunk=*/*.csv"


def chunk_of(path: str) -> Column:
    return F.regexp_extract(path, r"chunk=(\d+)", 1).cast("bigint")
