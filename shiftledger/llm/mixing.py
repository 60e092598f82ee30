"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target in words: the budget is shared by weight, no source gets more than
``most_copies`` times its size, and what is cut off goes to the others by weight. Within a source
a document expects ``min(most_copies, c * merit)`` copies, with ``c`` set so that expected words
meet the target. The whole part of it is taken for certain. The rest is the inclusion probability
``p`` of a sample of fixed size in words: documents are ranked by ``u / (1 - u)`` over
``p / (1 - p)``, the smallest ranks are taken as long as they fit, and one further document of the
source fills the gap if that brings the words closer to the target.

The rank is cut into ``BUCKETS`` parts. Only sums per source and part and the one part that holds
the border are looked at more closely, so a source with a third of all rows needs no large window.
Ranks depend on ``doc_id`` alone and reruns agree. Rows that agree in source, ``doc_id`` and size
are taken together or not at all. Null or word-less texts have size zero and no words to take; a
null source is a source of its own, after all others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_bits(size: Column) -> Column:
    """Merit of a document: binary digits of its size, so longer ones are a little likelier."""
    return F.length(F.bin(size)).cast("bigint")


def _uniform(doc_id: Column) -> Column:
    """A fixed number in (0, 1) for each id, from 52 bits of a digest."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most_copies: int
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources are few against documents, so their order is one window.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    ranked = (
        sizes.withColumn("place", F.row_number().over(place))
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * F.lit(most_copies))
    )
    left = F.sum("source_size").over(all_rows).cast("double") * share - F.coalesce(
        F.sum("cap").over(before), F.lit(0)
    ).cast("double")
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("level", left / open_weight.cast("double")).withColumn(
        "order", F.row_number().over(by_room)
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = level.withColumn(
        "level", F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("order"))).over(all_rows)
    )
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return level.select(
        "source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target")
    )


def _classes(sized: DataFrame, weights: Sequence[int], share: float, most_copies: int) -> DataFrame:
    """Per source and merit: whole copies, inclusion probability, and words the sample has to give."""
    groups = stage(
        sized.groupBy("source", "merit").agg(F.sum("size").alias("words")), "mix-groups"
    )
    sizes = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most_copies).withColumnRenamed("source", "_of")
    down = Window.partitionBy("source").orderBy(F.col("merit").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    rest = down.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy("source")
    full = F.coalesce(F.sum("words").over(before), F.lit(0)) * most_copies
    scale = F.try_divide(
        F.col("target") - full.cast("double"), F.sum(F.col("words") * F.col("merit")).over(rest).cast("double")
    )
    solved = groups.join(targets, F.col("source").eqNullSafe(F.col("_of"))).withColumn("scale", scale)
    fits = F.col("scale") * F.col("merit") <= most_copies
    solved = solved.withColumn(
        "scale", F.max_by(F.when(fits, F.col("scale")), F.when(fits, F.col("merit"))).over(all_rows)
    )
    copies = F.coalesce(
        F.least(F.lit(float(most_copies)), F.col("scale") * F.col("merit")), F.lit(float(most_copies))
    )
    solved = (
        solved.withColumn("copies", copies)
        .withColumn("certain", F.floor("copies"))
        .withColumn("chance", F.col("copies") - F.col("certain"))
    )
    need = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(all_rows).cast("double")
    return solved.select(
        F.col("source").alias("_source"), F.col("merit").alias("_merit"), "source_size", "target",
        "certain", "chance", need.alias("need"),
    )


def _ranked(sized: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with their class and their rank in (0, 1); null where there is nothing to draw."""
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance")))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("merit") == F.col("_merit"))
    return (
        sized.join(classes, same)
        .withColumn("rank", F.when(F.col("chance") > 0, odds / (1 + odds)))
        .withColumn("bucket", F.floor(F.col("rank") * BUCKETS))
    )


@dataclass
class Mix:
    """What decides a mix: small tables per source, staged."""

    classes: DataFrame
    cuts: DataFrame
    extras: DataFrame

    def of(self, sized: DataFrame) -> DataFrame:
        """Add ``source_size``, ``target``, ``copies`` to rows of ``source, size, merit, u``."""
        chosen = _selected(_ranked(sized, self.classes), self.cuts)
        extra = (F.col("rank") == F.col("_rank")) & (F.col("size") == F.col("_size"))
        same = F.col("source").eqNullSafe(F.col("_extra_of"))
        return chosen.join(self.extras, same, "left").withColumn(
            "copies",
            (F.col("certain") + F.coalesce((F.col("selected") | extra).cast("bigint"), F.lit(0))).cast("bigint"),
        )


def _selected(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    at = F.struct("rank", "size")
    fits = (
        F.col("_cut").isNull()
        | (F.col("bucket") < F.col("_cut"))
        | ((F.col("bucket") == F.col("_cut")) & F.coalesce(at <= F.col("_last"), F.lit(False)))
    )
    return ranked.join(cuts, F.col("source").eqNullSafe(F.col("_cut_of")), "left").withColumn(
        "selected", F.col("rank").isNotNull() & F.coalesce(fits, F.lit(True))
    )


def plan_mix(sized: DataFrame, weights: Sequence[int], share: float, most_copies: int) -> Mix:
    """Decide a mix over staged rows of ``source, size, merit, u``."""
    classes = stage(_classes(sized, weights, share, most_copies), "mix-classes")
    drawn = _ranked(sized, classes).where("rank IS NOT NULL")
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = (
        drawn.groupBy("source", "bucket", "need")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(running))
    )
    over = sums.where(F.col("upto") > F.col("need"))
    border = stage(
        over.groupBy(F.col("source").alias("_border_of")).agg(
            F.min("bucket").alias("border"), F.min(F.col("upto") - F.col("words")).alias("before")
        ),
        "mix-border",
    )
    in_order = Window.partitionBy("source").orderBy("rank", "size").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    edge = (
        drawn.join(border, F.col("source").eqNullSafe(F.col("_border_of")) & (F.col("bucket") == F.col("border")))
        .withColumn("upto", F.col("before") + F.sum("size").over(in_order))
    )
    inside = F.col("upto") <= F.col("need")
    cuts = stage(
        edge.groupBy(F.col("source").alias("_cut_of")).agg(
            F.max("border").alias("_cut"),
            F.max(F.when(inside, F.struct("rank", "size"))).alias("_last"),
            (F.max("need") - F.coalesce(F.max(F.when(inside, F.col("upto"))), F.max("before")).cast("double")).alias("_gap"),
        ),
        "mix-cuts",
    )
    left_out = _selected(drawn, cuts).where(
        ~F.col("selected") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("_gap"))
    )
    together = left_out.groupBy("source", "rank", "size", "_gap").agg(
        (F.count("*") * F.col("size")).alias("words")
    )
    miss = F.abs(F.col("_gap") - F.col("words"))
    extras = (
        together.where(miss < F.col("_gap"))
        .groupBy(F.col("source").alias("_extra_of"))
        .agg(F.min(F.struct(miss.alias("miss"), "rank", "size")).alias("best"))
        .select("_extra_of", F.col("best.rank").alias("_rank"), F.col("best.size").alias("_size"))
    )
    return Mix(classes, cuts, stage(extras, "mix-extras"))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    size = word_count(F.col("text"))
    return docs.select(*more, "source", size.alias("size"), _uniform(F.col("doc_id")).alias("u")).withColumn(
        "merit", size_bits(F.col("size"))
    )


def mix_decisions(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most_copies: int = 2
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``."""
    sized = stage(_sized(docs, F.col("doc_id")), "mix-sizes")
    mixed = plan_mix(sized, weights, share, most_copies).of(sized)
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most_copies: int = 2
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    plan = plan_mix(stage(_sized(docs), "mix-sizes"), weights, share, most_copies)
    rows = _sized(docs, F.struct("*").alias("row"))
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return (
        plan.of(rows).where("copies > 0").select("row", times.alias("copy")).select("row.*")
    )
