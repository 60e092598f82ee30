"""Stored Parquet tables: raw, validated and KPI rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .. import schemas as S
from ..functions import normalize_date
from ..sources.tables import is_path, table_exists
from .csv_export import export_csv

DESTINATIONS = ("table", "local")
CLUSTERINGS = ("local", "range")


def batch_name(instant: Column) -> Column:
    """The batch of a run, as its partition is named: the instant of ingestion in UTC."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    return F.date_format(utc, "yyyyMMdd'T'HHmmss'Z'")


#: Partition columns that follow from others.
_PARTITIONS = {
    "batch": lambda: batch_name(F.col("ingested_at")),
    "month": lambda: F.date_format(normalize_date(F.col("date")), "yyyy-MM"),
}


def disposition(write_mode: str | None) -> str:
    """``truncate`` replaces the table, anything else appends to it."""
    return "overwrite" if write_mode == "truncate" else "append"


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def require_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise if any of the columns holds a NULL; one narrow pass."""
    counts = null_counts(df, cols).first().asDict()
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ValueError(f"required columns hold NULL: {broken}")


def guarded(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in order; a NULL in a required one fails the write.

    The test rides along with the write, so the input is not computed twice for it.
    """

    def column(field):
        value = F.col(field.name)
        if not isinstance(field.dataType, ArrayType):
            value = value.cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        message = F.lit(f"required column holds NULL: {field.name}")
        return F.coalesce(value, F.raise_error(message).cast(field.dataType)).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _insert_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``df`` in a catalog table; the writer has no option for it there."""
    conf = df.sparkSession.conf
    before = conf.get(_OVERWRITE_MODE)
    conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(_OVERWRITE_MODE, before)


def save(df: DataFrame, table: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a table, replace it, or replace those of its partitions that ``df`` has rows of."""
    if mode not in ("append", "overwrite", "partitions"):
        raise ValueError(f"unknown write mode: {mode}")
    ordered = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
    if mode == "partitions" and not is_path(table) and table_exists(df.sparkSession, table):
        _insert_partitions(ordered, table)
        return
    # an overwrite replaces the table, also where the session would keep other partitions
    writer = (df if is_path(table) else ordered).write.format("parquet")
    writer = writer.mode("append" if mode == "append" else "overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if mode == "partitions" else "static")
    if is_path(table):
        writer.save(table)
    else:
        writer.saveAsTable(table)


def _clustered(df: DataFrame, cols: Sequence[str], cluster: str) -> DataFrame:
    """Sort rows by key, within the tasks they are in or over the whole table.

    ``local`` shuffles nothing: the row groups of each file cover narrow key ranges. Reading
    the latest record per key exchanges rows by key anyway, so it gains little from more.
    ``range`` also cuts the table into key ranges, for lookups by key that then open one file;
    it costs a shuffle of all rows and a second run of the input to find the ranges. The unique
    ``row_id`` is part of the range, so neither a key with very many rows nor the rows without
    a key end up in one task.
    """
    if cluster not in CLUSTERINGS:
        raise ValueError(f"unknown clustering: {cluster}")
    ranged = df.repartitionByRange(*cols) if cluster == "range" else df
    return ranged.sortWithinPartitions(*cols)


def _put(
    df: DataFrame,
    schema: StructType,
    table: str,
    mode: str,
    dest: str,
    sort_by: Sequence[str] = (),
    cluster: str = "local",
    partition_by: Sequence[str] = (),
) -> None:
    if dest == "local":
        export_csv(df, schema.names, table)
        return
    rows = guarded(df, schema)
    rows = rows.withColumns({c: _PARTITIONS[c]() for c in partition_by if c in _PARTITIONS})
    ordered = _clustered(rows, [*partition_by, *sort_by], cluster) if sort_by else rows
    save(ordered, table, mode, partition_by)


def write_raw(
    df: DataFrame,
    table: str,
    mode: str = "append",
    dest: str = "table",
    partition_by: Sequence[str] = (),
) -> None:
    """Source texts and ingestion metadata as they came; no shuffle."""
    _put(df, S.RAW_SCHEMA, table, mode, dest, partition_by=partition_by)


def write_validated(
    df: DataFrame,
    table: str,
    mode: str = "append",
    dest: str = "table",
    cluster: str = "local",
    partition_by: Sequence[str] = (),
) -> None:
    """Validated records, sorted for the deduplication view.

    Only here an unknown destination is an error; the other tables take it for ``table``.
    """
    if dest not in DESTINATIONS:
        raise ValueError(f"unknown destination {dest!r}, expected one of {DESTINATIONS}")
    sort_by = ("shift_log_id", "ingested_at", "row_id")
    _put(df, S.VALIDATED_SCHEMA, table, mode, dest, sort_by, cluster, partition_by)


def write_kpi(
    df: DataFrame,
    table: str,
    mode: str = "append",
    dest: str = "table",
    cluster: str = "local",
    by_month: bool = False,
) -> None:
    """KPI rows, sorted by business key, which is unique among them.

    With ``by_month`` the table has a partition for each month of the true date, beside the raw date
    text; ``report_filter`` uses it where it filters true dates.
    """
    _put(df, S.KPI_SCHEMA, table, mode, dest, ("shift_log_id",), cluster, ("month",) if by_month else ())
