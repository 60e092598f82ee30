"""Ranked lexical search: every item against all documents, by an Aho-Corasick scan of the texts.

Terms are runs of letters, digits and signs beyond ASCII, A-Z lower-cased. The terms of all items make
one automaton, each guarded by a blank on both sides, and a text is scanned with every sign between terms
made a blank: a match is then a whole term, and neighbours share the blank between them. The scan gives
a text's number of terms and how often it holds each term of an item; nothing else of the text is kept
and there is no index of documents. From the scan come the number of documents with terms, the sum of
their terms and each term's documents, and then each document's score for the items of its terms.
A task holds the best documents of each item so far, and these are ranked over all tasks.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, each with its own scan; a block's automaton is
all that is broadcast. An item is never split, so its scores are whole whatever the block.

Null and term-less texts are no documents here, items without terms have no results. Items that share an
id are one item, also those without id. Repeated documents rank each for itself; a document without id
ranks behind its equals. Without documents or items there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .decontaminate import _LOWER, _UPPER, words_of
from .texts import as_bytes, slices

TOP = 10
#: Pairs of item and term of one block: about 300 bytes each in a worker's automaton.
BLOCK_TERMS = 250_000
#: Scores of one slice of documents that a task holds at once.
CELLS = 1 << 21
#: Tasks whose best rows are ranked together before all are.
TASKS_TOGETHER = 256

_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_BLANK = 0x20
_built: list = [None, None]


@dataclass
class Query:
    """The items of one block: ids, distinct terms, and the places of the items that hold each term."""

    item_ids: list
    terms: list[str]
    holders: np.ndarray
    begins: np.ndarray


def build_automaton(terms: list[str]):
    """An automaton of guarded terms, whose output is a term's place. Bytes of UTF-8 are its letters."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(f" {term.encode().decode('latin-1')} ", i)
    found.make_automaton()
    return found


def _automaton(query: Query):
    """The automaton of a block, built once by each worker."""
    if _built[0] is not query:
        _built[:] = query, build_automaton(query.terms)
    return _built[1]


def count_terms(texts: list[bytes], automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text; then text, place of the term and count of all that the automaton found."""
    plain = [t.translate(_PLAIN) for t in texts]
    whole = b" " + b" ".join(plain) + b" "
    data = np.frombuffer(whole, np.uint8)
    begins = np.cumsum([1] + [len(t) + 1 for t in plain])
    starts = np.flatnonzero((data[1:] != _BLANK) & (data[:-1] == _BLANK)) + 1
    n = np.bincount(np.searchsorted(begins, starts, side="right") - 1, minlength=len(texts))
    flat = np.fromiter(chain.from_iterable(automaton.iter(whole.decode("latin-1"))), np.int64)
    # a match ends on the blank behind the term, which may be the one between two texts
    text = np.searchsorted(begins, flat[0::2] - 1, side="right") - 1
    key, times = np.unique((text << 32) | flat[1::2], return_counts=True)
    return n, key >> 32, key & 0xFFFFFFFF, times


_SCAN = "doc_id bigint, n bigint, terms array<int>, times array<int>"


def _scan_batches(query):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(query.value)
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi in slices(texts, 1 << 21):
                n, text, term, times = count_terms(texts[lo:hi], automaton)
                ends = np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    return scan


class _Best:
    """The best documents of each item so far, best first."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.zeros(n_items, np.int64)
        none = np.empty(0, np.int64)
        self.item, self.score, self.doc, self.missing = none, none, none, none.astype(bool)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, score))
        doc, missing = np.concatenate((self.doc, doc)), np.concatenate((self.missing, missing))
        order = np.lexsort((doc, missing, -score, item))
        item, score, doc, missing = item[order], score[order], doc[order], missing[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.least[item[last]] = score[last]
        keep = rank < self.top
        self.item, self.score, self.doc, self.missing = item[keep], score[keep], doc[keep], missing[keep]


def add_up(weights: np.ndarray, query: Query, m: np.ndarray, row: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Scores by document (as many as ``m``) and item, from the terms found in the documents."""
    times = times.astype(np.int64)
    points = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[row]))
    held = query.begins[term + 1] - query.begins[term]
    ends = np.cumsum(held)
    place = np.repeat(query.begins[term] - (ends - held), held) + np.arange(int(held.sum()))
    scores = np.zeros(len(m) * len(query.item_ids), np.int64)
    np.add.at(scores, np.repeat(row, held) * len(query.item_ids) + query.holders[place], np.repeat(points, held))
    return scores.reshape(len(m), -1)


def _score_batches(query, weights, n_docs: int, n_terms: int, top: int, cells: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, weight = query.value, weights.value
        best = _Best(len(its.item_ids), top)
        step = max(1, cells // max(1, len(its.item_ids)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                ids = part.column("doc_id")
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                m = 10 + (90 * part.column("n").to_numpy() * n_docs) // n_terms
                term, times = part.column("terms"), part.column("times").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), term.value_lengths().to_numpy())
                scores = add_up(weight, its, m, row, term.flatten().to_numpy(), times)
                at, item = np.nonzero((scores > 0) & (scores >= best.least))
                best.add(item, scores[at, item], doc[at], missing[at])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item.astype(np.int32)),
                pa.array(best.doc, pa.int64(), mask=best.missing),
                pa.array(best.score, pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return rank


def _ranked(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _query(rows: list) -> Query:
    """Items and terms in a fixed order, and which items hold which term."""
    ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
    place = {i: n for n, i in enumerate(ids)}
    terms = sorted({r.term for r in rows})
    number = {t: n for n, t in enumerate(terms)}
    pairs = sorted((number[r.term], place[r.item_id]) for r in rows)
    holders = np.array([i for _, i in pairs], np.int64)
    return Query(ids, terms, holders, np.searchsorted([t for t, _ in pairs], np.arange(len(terms) + 1)))


def _search_block(docs: DataFrame, rows: list, top: int, cells: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` for the items of one block."""
    spark = docs.sparkSession
    context = spark.sparkContext
    query = _query(rows)
    sent = context.broadcast(query)
    scanned = stage(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_scan_batches(sent), _SCAN), "term-counts")
    facts = scanned.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counts = scanned.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(query.terms), np.int64)
    for term, its_docs in counts:
        weights[term] = floor(1000 * log((2 * facts.docs + 2) / (2 * its_docs + 1)))
    scores = _score_batches(sent, context.broadcast(weights), facts.docs, max(1, facts.terms), top, cells)
    best = scanned.where(F.size("terms") > 0).mapInArrow(scores, "item int, doc_id bigint, score bigint")
    best = best.withColumn("group", F.expr(f"spark_partition_id() div {TASKS_TOGETHER}"))
    best = _ranked(_ranked(best, ["item", "group"], top), ["item"], top)
    kind = "item int, item_id bigint"
    names = spark.createDataFrame(list(enumerate(query.item_ids)), kind)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, cells: int = CELLS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above zero."""
    term = F.explode(words_of(F.translate("text", _UPPER, _LOWER)))
    pairs = stage(items.select(F.col("item_id").cast("bigint"), term.alias("term")).distinct(), "item-terms")
    blocks = max(1, -(-pairs.count() // block_terms))
    numbered = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    results = []
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item_id", "term").collect()
        if rows:
            results.append(_search_block(docs, rows, top, cells))
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.union, results)
