"""Bounded labelled samples for models that are fitted on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text is 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def water_level(counts: list[int], most: int) -> int:
    """The largest level (1 at least) at which groups, each cut at it, have ``most`` rows together at most."""
    left, waiting = most, sorted(counts)
    while waiting and waiting[0] * len(waiting) <= left:
        left -= waiting.pop(0)
    return max(1, left // len(waiting)) if waiting else max([1, *counts])


def _agreed(labels: DataFrame, *columns: str) -> DataFrame:
    """Ids that may be learned from, each once, with ``columns`` of its labels; an id with two different labels has none."""
    return (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.struct(*columns).alias("label")).where(" AND ".join(f"label.{c} IS NOT NULL" for c in columns))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").select("doc_id", "label.*")
    )


def learnable_rows(docs: DataFrame, labels: DataFrame, *columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """All rows that ``labelled_sample`` chooses from, with their whole texts, an id once."""
    rows = docs.where(F.length("text") > 0).select("doc_id", F.struct("text", *[F.coalesce(c, F.lit("")).alias(c) for c in keep]).alias("row"))
    one = rows.join(_agreed(labels, *columns), "doc_id").groupBy("doc_id", *columns).agg(F.min("row").alias("row"))
    return one.select("doc_id", *columns, "row.*")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, most: int, most_chars: int, *columns: str, group: str, keep: tuple[str, ...] = ()
) -> tuple[pd.DataFrame, dict[str, int]]:
    """Examples to learn from, and the number of all learnable rows by ``group``.

    The examples have ``text``, ``columns`` of the labels and ``keep`` of the documents (no null in the
    latter). ``labels`` has ``doc_id`` and ``columns``; an id with two different labels has none. Small groups give all their rows
    and large ones equally many, in the order of a hash of the id, so that together there are ``most``
    rows, and no rare group is lost. A group also ends with the text that reaches its share of
    ``most_chars``, whatever the length of texts; only a text longer than that share is no example. So
    the driver gets twice ``most_chars`` at most. Only a list of ``most`` ids is sent to the scan.
    """
    known = _agreed(labels, *columns)
    given = {c: F.coalesce(F.col(c), F.lit("")) for c in keep}
    sized = (
        docs.where(F.length("text") > 0).select("doc_id", F.length("text").alias("size"), *[v.alias(c) for c, v in given.items()])
        .groupBy("doc_id").agg(F.max("size").alias("size"), *[F.min(c).alias(c) for c in keep])
    )
    learnable = stage(known.join(sized, "doc_id"), "learnable")
    counts = {r[0]: r[1] for r in learnable.groupBy(group).count().collect()}
    level, share = water_level(list(counts.values()), most), most_chars // max(1, len(counts))
    in_group = Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id")
    before = F.coalesce(F.sum("size").over(in_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = (
        learnable.where(F.col("size") <= share)
        .withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= level)
        .withColumn("before", before).where(F.col("before") < share)
        .orderBy("rank", F.xxhash64("doc_id"), "doc_id").limit(most)
        .select("doc_id", *columns)
    )
    rows = (
        docs.where(F.length("text") > 0).select("doc_id", "text", *[v.alias(c) for c, v in given.items() if c not in columns])
        .join(F.broadcast(chosen), "doc_id")
    )
    # equal ids may repeat; the order makes training the same every time
    found = rows.where(F.length("text") <= share).toArrow().to_pandas().sort_values(["doc_id", "text"], kind="stable")
    return found.drop_duplicates("doc_id").reset_index(drop=True), counts
