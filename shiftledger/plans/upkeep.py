"""Views kept up batch by batch instead of being built anew.

Three things are stored beside the validated table:

* the latest record of every key, in parts by month of production (a key names a date, so its records
  share a month) and, for large months, by hash of the key;
* sums of the KPI rows of each part in the finest grouping of any view;
* counts for the quality views, for each batch.

``update_views`` looks at the batches that are whole and not yet in the views. It reads their rows, and
of the stored parts only those that they touch, writes these anew as another version, and ends with
one entry in a log: the versions that hold from now on and the batches in them. The log grows by one
file at a time, so a reader sees all of an update or nothing, and a job that fails leaves versions
that nobody reads. Updates have to run one after the other.

Records without a key replace nothing, so those of each update stay a part of their own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from .. import schemas as S
from ..operators.dedup import dedup_latest
from ..session import stage
from ..sinks.tables import save
from ..sources.tables import TableNames, is_path, read_table, table_exists
from . import operations as ops
from . import quality
from .batches import PARTITIONS, whole_batches, with_batch
from .staging import stg_shift_logs

PART = ("month", "part", "version")
#: Month of the records without a key.
KEYLESS = "keyless"
# fixed value: the columns of the log
LOG_SCHEMA = "number bigint, month string, part int, version string, run_id string, batch string"


@dataclass(frozen=True)
class Parts:
    """The versions that hold: ``(month, part, version)``."""

    held: frozenset[tuple[str, int, str]]

    def of(self, touched: set[tuple[str, int]]) -> Parts:
        return Parts(frozenset(p for p in self.held if p[:2] in touched))

    def within(self, dates: tuple[str, str] | None) -> Parts:
        if dates is None:
            return self
        first, last = dates[0][:7], dates[1][:7]
        return Parts(frozenset(p for p in self.held if p[0] == KEYLESS or first <= p[0] <= last))

    def filter(self) -> Column:
        """A condition on partition columns alone, so other parts are not opened."""
        return F.concat_ws("/", *PART).isin(sorted(f"{m}/{p}/{v}" for m, p, v in self.held))


def _log(spark: SparkSession, tables: TableNames) -> DataFrame:
    table = tables.of("upkeep")
    if not table_exists(spark, table):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(table) if is_path(table) else spark.read.table(table)


def held_parts(spark: SparkSession, tables: TableNames) -> Parts:
    """The newest version of each part, and all of the records without a key.

    One row per month and part reaches the driver, and one per update for records without a key.
    """
    entries = _log(spark, tables).where(F.col("month").isNotNull())
    own = F.when(F.col("month") == KEYLESS, F.col("version"))
    newest = entries.groupBy("month", "part", own.alias("own")).agg(F.max_by("version", "number").alias("version"))
    return Parts(frozenset((r.month, r.part, r.version) for r in newest.collect()))


def viewed_batches(spark: SparkSession, tables: TableNames) -> DataFrame:
    return _log(spark, tables).where(F.col("batch").isNotNull()).select(*PARTITIONS).distinct()


def _named(columns: tuple[str, ...], rows: list) -> Column:
    return F.concat_ws("/", *columns).isin(["/".join(map(str, row)) for row in rows])


def _with_parts(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    wide = StructType([*schema.fields]).add("month", StringType()).add("part", IntegerType()).add("version", StringType())
    return read_table(spark, table, wide)


def _held_rows(spark: SparkSession, tables: TableNames, parts: Parts) -> DataFrame:
    """Latest records of the given parts, with month and part."""
    return _with_parts(spark, tables.of("latest"), S.VALIDATED_SCHEMA).where(parts.filter()).drop("version")


def _placed(rows: DataFrame, parts_per_month: int) -> DataFrame:
    keyless = F.col("shift_log_id").isNull()
    month = F.coalesce(F.date_format("production_date", "yyyy-MM"), F.lit("none"))
    part = F.pmod(F.xxhash64("shift_log_id"), F.lit(parts_per_month)).cast("int")
    return rows.withColumns(
        {"month": F.when(keyless, F.lit(KEYLESS)).otherwise(month), "part": F.when(keyless, 0).otherwise(part)}
    )


def _commit(spark: SparkSession, tables: TableNames, touched: list, version: str, batches: list) -> None:
    """One file with all that an update has changed."""
    last = _log(spark, tables).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    entries = [(last + 1, month, part, version, None, None) for month, part in touched]
    entries += [(last + 1, None, None, None, run_id, batch) for run_id, batch in batches]
    save(spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1), tables.of("upkeep"), "append")


def update_views(
    spark: SparkSession, tables: TableNames, parts_per_month: int = 1, valid_first: bool = False
) -> int:
    """Bring the stored views up to the whole batches; the number of batches that were new.

    ``parts_per_month`` cuts a month by hash of the key, so that a part stays below some gigabytes;
    it and ``valid_first`` have to stay the same for a table.
    """
    pending = whole_batches(spark, tables).join(viewed_batches(spark, tables), list(PARTITIONS), "left_anti")
    new_batches = sorted((r.run_id, r.batch) for r in pending.collect())
    if not new_batches:
        return 0
    version = uuid.uuid4().hex
    arrived = with_batch(spark, tables.validated, S.VALIDATED_SCHEMA).where(_named(PARTITIONS, new_batches))

    staged, scope = stg_shift_logs(arrived, "batch"), (*quality.SCOPE, "batch")
    save(quality.metric_counts(staged, scope=scope), tables.of("metric_counts"), "partitions", PARTITIONS)
    save(quality.invalid_reason_counts(staged, scope), tables.of("reason_counts"), "partitions", PARTITIONS)

    placed = _placed(arrived.drop("batch"), parts_per_month)
    newest = stage(dedup_latest(placed, valid_first=valid_first), "newest")
    touched = {(r.month, r.part) for r in newest.select("month", "part").distinct().collect()}
    old = held_parts(spark, tables).of(touched)
    if old.held:
        newest = dedup_latest(_held_rows(spark, tables, old).unionByName(newest), valid_first=valid_first)
    rows = newest.unionByName(placed.where(F.col("shift_log_id").isNull())).withColumn("version", F.lit(version))
    # adaptive execution cuts the rows of large months and joins those of small ones
    dealt = rows.hint("rebalance", "month", "part").sortWithinPartitions(*PART, "shift_log_id")
    save(dealt, tables.of("latest"), "append", PART)

    written = _with_parts(spark, tables.of("latest"), S.VALIDATED_SCHEMA).where(F.col("version") == version)
    kpi = ops.shift_log_kpi(stg_shift_logs(written, *PART), *PART)
    save(ops.kpi_partials(kpi, *PART), tables.of("kpi_partials"), "append", PART)

    places = [(r.month, r.part) for r in written.select("month", "part").distinct().collect()]
    _commit(spark, tables, sorted(places), version, new_batches)
    return len(new_batches)


def latest_view(
    spark: SparkSession, tables: TableNames, dates: tuple[str, str] | None = None
) -> DataFrame:
    """The deduplicated view (columns of the validated table) from the stored parts.

    ``dates`` is a range of production dates; parts of other months are not opened.
    """
    rows = _held_rows(spark, tables, held_parts(spark, tables).within(dates)).select(*S.VALIDATED_SCHEMA.names)
    if dates is None:
        return rows
    return rows.where(F.col("production_date").between(*[F.lit(d).cast("date") for d in dates]))


def stored_partials(spark: SparkSession, tables: TableNames) -> DataFrame:
    """Sums of all KPI rows by date, line, shift and reason; several rows for one such group."""
    schema = StructType()
    for name in ops.PARTIAL_KEYS:
        schema.add(name, StringType())
    for name in ("shift_count", *ops.SUMS):
        schema.add(name, LongType())
    return _with_parts(spark, tables.of("kpi_partials"), schema).where(held_parts(spark, tables).filter()).drop(*PART)


def _of_viewed(spark: SparkSession, tables: TableNames, layer: str) -> DataFrame:
    viewed = viewed_batches(spark, tables)
    return read_table(spark, tables.of(layer)).join(viewed, list(PARTITIONS), "left_semi")


def kept_up_views(spark: SparkSession, tables: TableNames) -> dict[str, DataFrame]:
    """Views of the mart from what is stored for them; none reads the validated table.

    Views that are sums read sums, the record-level ones read the latest records.
    """
    latest, partials = latest_view(spark, tables), stored_partials(spark, tables)
    kpi = ops.shift_log_kpi(stg_shift_logs(latest))
    reasons = quality.add_reason_counts(_of_viewed(spark, tables, "reason_counts"))
    return {
        "shift_log_validated_dedup": stg_shift_logs(latest),
        "v_dq_metrics_by_run": quality.metrics_of_counts(
            quality.add_metric_counts(_of_viewed(spark, tables, "metric_counts"))
        ),
        "v_dq_invalid_reasons_by_run": quality.most_frequent_first(reasons),
        "shift_log_kpi": kpi,
        "v_manufacturing_kpi_summary": ops.partials_by(partials),
        "v_manufacturing_kpi_daily_trend": ops.partials_by(partials, "date"),
        "v_manufacturing_kpi_by_line": ops.partials_by(partials, "line"),
        "v_manufacturing_kpi_by_shift": ops.partials_by(partials, "shift"),
        "v_downtime_reason_pareto": ops.downtime_pareto(partials),
        "v_line_shift_performance": ops.partials_by(partials, "line", "shift"),
        "v_shift_log_kpi_drilldown": ops.kpi_drilldown(kpi),
    }
