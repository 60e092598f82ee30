"""Latest record per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    key: str = "shift_log_id",
    order: Sequence[str] = ("ingested_at", "row_id"),
    valid_first: bool = False,
) -> DataFrame:
    """Keep the latest record of every non-NULL key, valid or not.

    The rank filter lets Spark keep one row per key and task before it shuffles, so a key with
    very many rows costs one row per map task. ``valid_first`` prefers valid records.
    """
    ranking = [F.col(c).desc() for c in order]
    if valid_first:
        ranking.insert(0, F.col("is_valid").desc())
    latest = Window.partitionBy(key).orderBy(*ranking)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def validated_dedup(staged: DataFrame, key: str = "shift_log_id", **options) -> DataFrame:
    """Latest record per key plus every record without a key.

    Records without a key bypass the window: as one NULL group they would meet in one task.
    """
    return dedup_latest(staged, key, **options).unionByName(staged.where(F.col(key).isNull()))
