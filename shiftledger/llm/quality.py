"""Quality rules: counts of each text, and a log-likelihood ratio of hashed word n-grams.

Words and neighbouring pairs of words are hashed into ``BUCKETS``. One multinomial over the buckets
is counted over all documents, another over documents that are trusted (labelled as good). The
score of a document is the mean over its n-grams of ``log(p_trusted / p_all)``. A document is kept
if it passes the base rules and its score reaches the threshold, which is set on all labelled
documents: losing a good one costs ``GOOD_COST`` times as much as keeping a bad one.

The trusted multinomial is fitted on at most ``TRUSTED_DOCS`` documents (those with the smallest
hash of their id); everything else is counted over all rows. Without usable labels the threshold
is minus infinity and the base rules decide alone. A null or word-less text has no words, scores
zero and fails the base rules. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .texts import SPACE, as_bytes, joined, pair_hashes, prefix_sums, slices, span_hashes, text_of, words_of

BUCKETS = 1 << 16
TRUSTED_DOCS = 50_000
SMOOTHING = 1.0
GOOD_COST = 10.0
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SCORE_BINS_PER_UNIT = 200

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SHIFT = np.uint64(64 - (BUCKETS - 1).bit_length())
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[begins])


class Words:
    """Words of joined texts: hash, and number of the text."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.data, self.begins = joined(texts)
        self.sums = prefix_sums(self.data)
        begin, end = words_of(self.data)
        self.hash = span_hashes(self.sums, begin, end)
        self.row = text_of(self.begins, begin)

    def ngrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of every word and of every pair of neighbours."""
        pair = np.flatnonzero(self.row[1:] == self.row[:-1])
        both = np.concatenate((self.hash, pair_hashes(self.hash[pair], self.hash[pair + 1])))
        return (both >> _SHIFT).astype(np.int64), np.concatenate((self.row, self.row[pair]))

    def stats(self) -> list[np.ndarray]:
        """The counts named in ``_STATS`` for each text."""
        inside = ~SPACE[self.data]
        n_words = np.bincount(self.row, minlength=self.n)
        chars = _per_text(inside & ((self.data & 0xC0) != 0x80), self.begins)
        symbols = _per_text(_SYMBOL[self.data], self.begins)
        return [n_words, chars, symbols, self._dup_lines(inside), self._repeat_words()]

    def _dup_lines(self, inside: np.ndarray) -> np.ndarray:
        end = np.flatnonzero(self.data == 0x0A)
        begin = np.concatenate(([0], end[:-1] + 1))
        count = np.zeros(len(inside) + 1, dtype=np.int64)
        np.cumsum(inside, out=count[1:])
        filled = count[end] > count[begin]
        begin, end = begin[filled], end[filled]
        row = text_of(self.begins, begin)
        of_text = pair_hashes(span_hashes(self.sums, begin, end), row.astype(np.uint64))
        first = np.unique(of_text, return_index=True)[1]
        lines = np.bincount(row, minlength=self.n)
        return lines - np.bincount(row[first], minlength=self.n)

    def _repeat_words(self) -> np.ndarray:
        width = REPEAT_WINDOW
        n = len(self.hash)
        if n < width:
            return np.zeros(self.n, dtype=np.int64)
        whole = np.flatnonzero(self.row[width - 1 :] == self.row[: n - width + 1])
        if not len(whole):
            return np.zeros(self.n, dtype=np.int64)
        key = self.row[whole].astype(np.uint64)
        for i in range(width):
            key = pair_hashes(key, self.hash[whole + i]) if i in (0, width - 1) else key * np.uint64(
                0x9E3779B97F4A7C15
            ) + self.hash[whole + i]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        begin = whole[order[twice]]
        step = np.bincount(begin, minlength=n + 1) - np.bincount(begin + width, minlength=n + 1)[: n + 1]
        covered = np.cumsum(step[:n]) > 0
        return np.bincount(self.row[covered], minlength=self.n)


def _count_batches(trusted: np.ndarray):
    """Bucket counts of a partition, over all texts and over those with a trusted id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(-1))
            is_good = np.isin(ids, trusted) & ~np.asarray(batch.column("doc_id").is_null())
            texts = as_bytes(batch.column("text"))
            for lo, hi in slices(texts):
                bucket, row = Words(texts[lo:hi]).ngrams()
                every += np.bincount(bucket, minlength=BUCKETS)
                good += np.bincount(bucket[is_good[lo:hi][row]], minlength=BUCKETS)
        seen = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(every[seen]), pa.array(good[seen])], ["bucket", "every", "good"]
        )

    return count


def log_ratios(docs: DataFrame, labels: DataFrame, trusted_docs: int = TRUSTED_DOCS) -> np.ndarray:
    """``log(p_trusted / p_all)`` by bucket. The driver gets one row per bucket and the trusted ids."""
    chosen = (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs)
    )
    trusted = np.array(sorted(r.doc_id for r in chosen.collect()), dtype=np.int64)
    counts = (
        docs.select("doc_id", "text")
        .mapInArrow(_count_batches(trusted), "bucket bigint, every bigint, good bigint")
        .groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("good").alias("good"))
        .collect()
    )
    every, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts:
        every[row.bucket], good[row.bucket] = row.every, row.good
    if not good.any():
        return np.zeros(BUCKETS)
    p = (good + SMOOTHING) / (good.sum() + SMOOTHING * BUCKETS)
    q = (every + SMOOTHING) / (every.sum() + SMOOTHING * BUCKETS)
    return np.log(p / q)


def measured(text: Column, ratios: np.ndarray) -> Column:
    """Struct of the counts of a text and its score."""
    kind = "struct<" + ",".join(f"{name}:bigint" for name in _STATS) + ",score:double>"

    def measure(texts: pa.Array) -> pa.Array:
        raw = as_bytes(texts)
        parts = []
        for lo, hi in slices(raw):
            words = Words(raw[lo:hi])
            bucket, row = words.ngrams()
            n = np.bincount(row, minlength=words.n)
            total = np.bincount(row, weights=ratios[bucket], minlength=words.n)
            parts.append([*words.stats(), total / np.maximum(n, 1)])
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0)] * 6
        kinds = [pa.int64()] * len(_STATS) + [pa.float64()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*_STATS, "score"]
        )

    return F.arrow_udf(measure, kind)(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def threshold(scored: DataFrame, labels: DataFrame, good_cost: float = GOOD_COST) -> float:
    """The score at which labelled documents that pass the base rules are best told apart.

    Only counts by score bin reach the driver. Of equally good thresholds the lowest is taken.
    """
    bin_ = F.floor(F.col("score") * SCORE_BINS_PER_UNIT)
    rows = (
        scored.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .select("doc_id", bin_.alias("bin"))
        .join(labels.where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id")
        .groupBy("bin")
        .agg(F.sum((F.col("quality") == 1).cast("bigint")).alias("good"), F.sum((F.col("quality") != 1).cast("bigint")).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    if not rows:
        return float("-inf")
    good = np.array([r.good for r in rows])
    bad = np.array([r.bad for r in rows])
    # cost of a threshold below bin i: good ones under it are lost, bad ones from it on are kept
    lost = np.concatenate(([0], np.cumsum(good)))
    kept = bad.sum() - np.concatenate(([0], np.cumsum(bad)))
    best = int(np.argmin(good_cost * lost + kept))
    if best == 0:
        return float("-inf")
    # halfway to the next bin that holds anything
    below = rows[best - 1].bin + 1
    above = rows[best].bin if best < len(rows) else below
    return (below + above) / 2 / SCORE_BINS_PER_UNIT


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``score``, ``base_failed`` and ``kept`` for every row of ``docs``."""
    ratios = log_ratios(docs, labels)
    scored = stage(
        docs.select("doc_id", measured(F.col("text"), ratios).alias("m")).select("doc_id", "m.*"), "scores"
    )
    least = threshold(scored, labels)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return scored.select("*", failed.alias("base_failed"), (~failed & (F.col("score") >= least)).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    ratios = log_ratios(docs, labels)
    m = measured(F.col("text"), ratios).alias("m")
    scored = stage(docs.select("doc_id", m).select("doc_id", "m.*"), "scores")
    least = threshold(scored, labels)
    passes = ~base_failed(F.col("m.n_words"), F.col("m.n_repeat_words")) & (F.col("m.score") >= least)
    return docs.select(F.struct("*").alias("row"), m).where(passes).select("row.*")
