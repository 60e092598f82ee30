"""The validated table in buckets of its business key, from which the latest records need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import dedup_latest
from .tables import guarded

BUCKETS = 200
BUCKET_KEY = "bucket_key"
#: Records of one key that a bucket takes at most; with more, one task would read most of the table.
KEY_ROWS = 2_000_000


def _most_frequent(df: DataFrame, key: str) -> int:
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def write_validated_buckets(
    df: DataFrame,
    table: str,
    buckets: int = BUCKETS,
    mode: str = "append",
    path: str | None = None,
    key_rows: int = KEY_ROWS,
) -> None:
    """Validated records as a catalog table, bucketed and sorted by business key.

    One task writes one bucket. Records without a key are spread by their row id. A key of more than
    ``key_rows`` records in ``df`` is refused, since buckets cannot split it: store such records by
    ``write_validated`` with ranges, or keep the latest ones by ``update_views``, where a key is one row.
    """
    most = _most_frequent(df, "shift_log_id")
    if most > key_rows:
        raise ValueError(f"a key has {most} records, buckets take {key_rows}; use cluster='range'")
    rows = guarded(df, S.VALIDATED_SCHEMA).withColumn(BUCKET_KEY, F.coalesce("shift_log_id", "row_id"))
    order = (BUCKET_KEY, "ingested_at", "row_id")
    writer = rows.repartition(buckets, BUCKET_KEY).sortWithinPartitions(*order).write.format("parquet").mode(mode)
    writer = writer.bucketBy(buckets, BUCKET_KEY).sortBy(*order)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def latest_of_buckets(spark: SparkSession, table: str, valid_first: bool = False) -> DataFrame:
    """The latest record of every key of a bucketed table: each task reads whole keys, nothing moves."""
    keyed = spark.read.table(table).where(F.col("shift_log_id").isNotNull())
    return dedup_latest(keyed, BUCKET_KEY, valid_first=valid_first).drop(BUCKET_KEY)
