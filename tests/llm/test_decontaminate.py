import random
import re

import pytest
from pyspark.sql import functions as F

from shiftledger.llm.decontaminate import contamination, item_windows, window_hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def judged(text, items, window):
    """Words, hit words and items by trying every window at every place."""
    its, hit, found = words(text), set(), set()
    for item_id, item in items:
        its_words = words(item)
        if not its_words:
            continue
        for b in range(max(1, len(its_words) - window + 1)):
            part = its_words[b : b + window]
            for at in range(len(its) - len(part) + 1):
                if its[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(its), len(hit), sorted(found), bool(hit)


def test_against_every_place(spark):
    rng = random.Random(5)
    vocabulary = ["a", "B", "the", "É", "é", "x1", "2", "straße", "Ünder", "of"]
    signs = [" ", " ", " ", "\n", "\t", ", ", "-", "...", "\x00", "\u007f"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 4, 5, 9]))) for i in range(30)]
    items += [(3, text(6)), (None, "nameless of the Ünder kind"), (50, None), (51, " .,-"), (52, "")]
    docs = [(i, text(rng.choice([0, 1, 3, 10, 40]))) for i in range(60)]
    docs += [(i, text(3) + items[i][1] + text(3)) for i in range(30)]
    docs += [(7, None), (None, ""), (None, "Nameless, of the Ünder... KIND"), (8, items[4][1]), (8, items[4][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("window", F.lit("w"))
    given = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9)).withColumn("n", F.lit(0))
    for window, shingle in ((4, 3), (5, 2), (3, 5)):
        want = sorted(repr((d, *judged(t, items, window))) for d, t in docs)
        for rows in (200_000, 0):  # with and without broadcasts
            found = contamination(frame, given, window, shingle, broadcast_rows=rows)
            assert sorted(repr(tuple(r)) for r in found.collect()) == want


def test_odd_documents(spark, odd_docs, no_docs):
    items = [(1, "the dog sat on the log by the fog the cat sat"), (2, "wort5é wort6é wort7é wort8é wort9é wort10é wort11é wort12é wort13é wort14é"), (3, "another text")]
    given = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = contamination(odd_docs, given)
    assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(repr((d, *judged(t, items, 10))) for d, t in docs)
    assert contamination(no_docs, given).count() == 0
    assert contamination(odd_docs, given.where("false")).where("contaminated OR n_hit > 0").count() == 0


def test_copies_are_one_text(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(f"before {passage} after").alias("text"))
    hits, named = window_hits(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted((r.begin, r.n) for r in hits.collect()) == [(1, 10), (2, 10)]
    assert named.count() == 2
    assert item_windows(spark.createDataFrame([(1, passage), (1, passage)], "item_id long, text string")).count() == 2


def test_only_spark_functions(spark, sf_dir):
    from shiftledger.llm.queries import QUERIES

    plan = QUERIES["op12_decontamination"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["op12_decontamination"])
def test_finds_planted_passages(spark, sf_dir, name):
    from shiftledger.llm.queries import QUERIES

    bad = {r.doc_id for r in QUERIES[name](spark, sf_dir).where("contaminated").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert bad == {r.doc_id for r in docs if judged(r.text, items, 10)[3]}
