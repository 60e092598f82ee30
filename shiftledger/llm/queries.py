"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, toxicity
from .alignment import align_documents
from .ann import nearest_neighbours
from .decontaminate import contamination
from .html_crf import main_text_column
from .lexical import search
from .mixing import mix_decisions
from .oracle import ORACLE as ORACLE
from .packing import pack_documents
from .quality import quality_verdicts
from .repeats import removal_digest
from .sampling import held_out
from .shipping import ship_package
from .simhash import near_duplicate_classes
from .url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_decisions(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is bad if its label says low quality or toxic; ids of pages and labels agree."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    judged = filter_urls(table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return classes.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), query_every=20, k=20)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", main_text_column(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score_column(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.language_column(F.col("text"), langid.fit_on(docs))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OPERATORS = (
    op1_mixing, op2_url_filter, op3_simhash, op4_nearest, op5_quality,
    op6_packing, op7_suffix_dedup, op8_html, op9_toxicity, op10_language,
    op11_alignment, op12_decontamination, op13_search,
)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {q.__name__: _shipped(q) for q in _OPERATORS}
