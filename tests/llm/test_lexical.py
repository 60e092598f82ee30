import random
import re
from collections import Counter
from math import floor, log

import numpy as np
from pyspark.sql import functions as F

from shiftledger.llm.lexical import build_automaton, count_terms, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranked(docs, items, top):
    """Every document scored for every item."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, its in wanted.items():
        scores = []
        for d, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in its if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(scores[:top])]
    return sorted(map(repr, out))


def found(frame):
    return sorted(repr(tuple(r)) for r in frame.collect())


def test_against_every_pair(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "the", "É", "é", "x1", "2", "straße", "Ünder", "of", "日本", "ab", "abc", "bc", "𝄞x"]
    signs = [" ", " ", "\n", ", ", "-", "...", "\x00", "\u007f", "@", "{"]

    def text(n):
        return rng.choice(["", " ", "."]) + "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(n))

    docs = [(i, text(rng.choice([0, 1, 3, 10, 60]))) for i in range(150)]
    docs += [(7, None), (None, "the abc"), (None, "the abc"), (9, "the abc"), (8, "the abc"), (1000, "nothing of it"), (-3, "the abc"), (5, "A")]
    items = [(i, text(rng.choice([0, 1, 2, 9]))) for i in range(25)]
    items += [(2, "ABC 日本"), (None, "straße"), (None, "𝄞x"), (60, None), (61, "?!"), (62, "unseen words")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("rank", F.lit("w"))
    given = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9)).withColumn("term", F.lit("w"))
    for top, block, cells in ((10, 250_000, 1 << 21), (3, 10, 50), (1000, 250_000, 1)):
        assert found(search(frame.repartition(5), given, top, block, cells)) == ranked(docs, items, top)


def test_odd_documents(spark, odd_docs, no_docs):
    items = [(1, "The cat and the dog"), (2, "wort5é wort29999é katze"), (3, "1234 text")]
    given = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(search(odd_docs, given)) == ranked(docs, items, 10)
    assert search(no_docs, given).count() == 0
    assert search(odd_docs, given.where("false")).count() == 0
    assert search(odd_docs.where("doc_id = 3"), given).count() == 0


def test_terms_do_not_run_over_ends():
    automaton = build_automaton(["ab", "b", "é"])
    n, text, term, times = count_terms([b"ab", b"", b"b ab,ab", "éb É é".encode(), b" "], automaton)
    assert n.tolist() == [1, 0, 3, 3, 0]
    assert list(zip(text.tolist(), term.tolist(), times.tolist())) == [(0, 0, 1), (2, 0, 2), (2, 1, 1), (3, 2, 1)]
    assert np.issubdtype(times.dtype, np.integer)
