"""Repeated records inside one ingested file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import dealt

# A key with more rows than this is settled by aggregation instead of a window, so no
# window group grows past the order of HOT_ROWS rows (about half a gigabyte).
HOT_ROWS = 2_000_000
# Share of rows looked at to find such keys. It only decides which of two exact ways a key
# takes: a key of HOT_ROWS rows shows up 20,000 times, far from the half used as threshold.
PROBE_FRACTION = 0.01
# Rows one task of the window sorts, about a hundred megabytes of raw records.
TASK_ROWS = 250_000


def _usable(keys: Sequence[str]) -> Column:
    """NULL or empty key parts keep a record out of duplicate detection."""
    usable = F.lit(True)
    for name in keys:
        usable = usable & (F.coalesce(F.col(name).cast("string"), F.lit("")) != "")
    return usable


def _first_rows_of_hot_keys(
    df: DataFrame, group: list[str], usable: Column, hot_rows: int, fraction: float
) -> DataFrame:
    """First row (number and id) of each key that holds very many rows.

    Both steps aggregate before they shuffle, so a key with a third of all rows leaves each
    task as one row. The result holds at most about ``2 * rows / hot_rows`` keys, a million of them
    in 10^12 rows, so it is broadcast: Spark then knows before the second pass begins whether there is
    any such key, and without one neither that pass nor a shuffle for the join is run.
    """
    keyed = df.where(usable).select(*group, "row_number", "row_id")
    probed = keyed if fraction >= 1 else keyed.sample(fraction=fraction, seed=7)
    hot_keys = (
        probed.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= max(1, int(hot_rows * min(fraction, 1) / 2)))
        .select(*group)
    )
    return (
        keyed.join(F.broadcast(hot_keys), group, "left_semi")
        .groupBy(*group)
        .agg(F.min(F.struct("row_number", "row_id")).alias("first_row"))
    )


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("date", "shift", "line"),
    scope: Sequence[str] = ("run_id", "source_file"),
    hot_rows: int = HOT_ROWS,
    probe_fraction: float = PROBE_FRACTION,
) -> DataFrame:
    """Add ``is_duplicate``: true for every record after the first one of its key.

    The key is compared as exact text. "First" means the smallest ``row_number``, whether or
    not that record is valid. Ordinary keys take one window; keys too large for one task get
    the flag from a join with their first row, in the same order. Records that cannot be duplicates (unusable
    or hot key) are spread by their row number, so they never form a group of their own. The rows are
    counted when this is called, so that tasks of the window keep to ``TASK_ROWS`` or so however many there are.
    """
    group = [*scope, *keys]
    usable = _usable(keys)
    hot = _first_rows_of_hot_keys(df, group, usable, hot_rows, probe_fraction)
    marked = df.join(
        F.broadcast(hot.select(*[F.col(c).alias(f"hot_{c}") for c in group], "first_row")),
        [F.col(c) == F.col(f"hot_{c}") for c in group],
        "left",
    ).drop(*[f"hot_{c}" for c in group])
    settled = ~usable | F.col("first_row").isNotNull()
    spread = F.when(settled, F.col("row_number")).otherwise(F.lit(-1))
    alike = [*group, "_spread"]
    marked = dealt(marked.withColumn("_spread", spread), -(-df.count() // TASK_ROWS), *alike)
    position = F.row_number().over(Window.partitionBy(*alike).orderBy("row_number", "row_id"))
    repeated = (
        F.when(~usable, F.lit(False))
        .when(F.col("first_row").isNotNull(), F.struct("row_number", "row_id") > F.col("first_row"))
        .otherwise(position > 1)
    )
    return marked.withColumn("is_duplicate", repeated).drop("first_row", "_spread")
