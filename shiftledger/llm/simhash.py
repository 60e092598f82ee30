"""Near-duplicate classes by SimHash fingerprints and pigeonhole blocks.

A fingerprint is cut into blocks. Two fingerprints with at most ``distance`` differing bits leave
at least ``blocks - distance`` blocks equal, so they agree on one of the combinations of that many
blocks. Fingerprints meet by combination, Hamming distances are verified there, and each meeting
place hands on a spanning forest of its links instead of all its pairs.

Rows with null or word-less text have fingerprint zero and link like any other. Repeated rows are
kept; a null ``doc_id`` never names a class, but its text links others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .components import connected_components
from .texts import as_bytes, giving_back

SHINGLE_WORDS = 4
DISTANCE = 4
#: Random fingerprints of one meeting place, from which the number of blocks follows.
PLACE_ROWS = 64
#: Fingerprints of one meeting place that are compared in one task; more are dealt over a grid.
GRID_ROWS = 4096
SEED = 42

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    width = min(shingle_words, len(words))
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(whole[b:e], SEED) for b, e in zip(begins, ends)]
    n = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _BITS_AT_ONCE):
        part = np.array(hashes[i : i + _BITS_AT_ONCE], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle_words) for t in as_bytes(texts)], dtype=np.uint64)
        return pa.array(found.view(np.int64), pa.int64())

    return fingerprints(text)


def _block_keys(fp: Column, blocks: int, distance: int) -> Column:
    """One key per combination of blocks that a close pair may share."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        for lo, hi in zip(edges, edges[1:])
    ]
    keys = []
    for table, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(table).cast("bigint")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            key = F.shiftleft(key, width).bitwiseOR(parts[i])
        keys.append(key)
    return F.array(*keys)


class _Forest:
    """Labels of rows, joined pair by pair; the smallest row number is the label."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _spanning_links(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the close fingerprints of each run of equal ``keys``."""
    n = len(keys)
    ends = np.searchsorted(keys, keys, side="right")
    at = np.arange(n)
    forest = _Forest(n)
    step = 1
    while True:
        at = at[at + step < ends[at]]
        if not len(at):
            break
        close = np.bitwise_count(fps[at] ^ fps[at + step]) <= distance
        if close.any():
            forest.join(at[close], at[close] + step)
        step += 1
    linked = np.flatnonzero(forest.label != np.arange(n))
    return fps[forest.label[linked]], fps[linked]


def _link_batches(distance: int):
    @giving_back
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = _spanning_links(keys, fps, distance)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

        for batch in batches:
            # two places under one hash only add comparisons, each of which is verified
            keys = np.concatenate((held_keys, batch.column("place").to_numpy()))
            fps = np.concatenate((held_fps, batch.column("fp").to_numpy().view(np.uint64)))
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0
            yield from out(keys[:whole], fps[:whole])
            held_keys, held_fps = keys[whole:], fps[whole:]
        yield from out(held_keys, held_fps)

    return link


def close_links(
    fps: DataFrame, distance: int = DISTANCE, blocks: int = DISTANCE + 2, grid_rows: int = GRID_ROWS
) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs within ``distance`` bits.

    ``fps`` has distinct longs ``fp``. Meeting places with more than ``grid_rows`` fingerprints are
    dealt over a grid of cells, each of which compares two shares of the place; every pair of
    shares has a cell, so no pair is lost and no task holds more than two shares.
    """
    if not 0 <= distance < blocks:
        raise ValueError("there have to be more blocks than differing bits")
    met = fps.select("fp", F.explode(_block_keys(F.col("fp"), blocks, distance)).alias("place"))
    crowded = stage(
        met.groupBy("place").count().where(F.col("count") > grid_rows)
        .select("place", F.ceil(F.col("count") / F.lit(grid_rows)).cast("bigint").alias("shares")),
        "crowded",
    )
    share = F.pmod(F.xxhash64("fp"), F.col("shares"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1))
    cell = F.xxhash64("place", F.least("share", "other"), F.greatest("share", "other"))
    dealt = (
        met.join(crowded, "place")
        .select("place", "fp", "shares", share.alias("share"))
        .select("place", "fp", "share", other.alias("other"))
        .select("fp", cell.alias("place"))
    )
    plain = met.join(crowded.select("place"), "place", "left_anti").select("fp", "place")
    placed = plain if crowded.isEmpty() else plain.union(dealt)
    return (
        placed.repartition("place")
        .sortWithinPartitions("place", "fp")
        .mapInArrow(_link_batches(distance), "a bigint, b bigint")
    )


def blocks_for(fingerprints: int, distance: int = DISTANCE) -> int:
    """Blocks that leave a meeting place of random fingerprints about ``PLACE_ROWS`` rows at most.

    More blocks make longer keys, and more of them: 15 keys of 21 bits, 35 of 27, 70 of 32 for a
    distance of four. What is found is the same.
    """
    blocks = distance + 2
    while blocks < 64 and fingerprints >> (64 * (blocks - distance) // blocks) > PLACE_ROWS:
        blocks += 1
    return blocks


def _marked(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id``, fingerprint and a hash of the text of every row; staged."""
    fp = fingerprint_column(F.col("text"), shingle_words)
    return stage(docs.select("doc_id", fp.alias("fp"), F.xxhash64("text").alias("hash")), "fingerprints")


def _fingerprint_classes(marked: DataFrame, distance: int, blocks: int | None, grid_rows: int) -> DataFrame:
    """``fp``, ``component`` (a fingerprint) and ``first_id`` of every distinct fingerprint; staged."""
    fps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    blocks = blocks or blocks_for(fps.count(), distance)
    linked = connected_components(close_links(fps.select("fp"), distance, blocks, grid_rows))
    classes = fps.join(
        linked.select(F.col("node").alias("fp"), "component"), "fp", "left"
    ).select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    return stage(classes, "classes")


def near_duplicate_classes(
    docs: DataFrame,
    distance: int = DISTANCE,
    blocks: int | None = None,
    shingle_words: int = SHINGLE_WORDS,
    grid_rows: int = GRID_ROWS,
) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most ``distance``
    differing bits, null only if no row of the class has an id. Without ``blocks`` their number
    follows from the number of fingerprints.
    """
    marked = _marked(docs, shingle_words)
    classes = _fingerprint_classes(marked, distance, blocks, grid_rows)
    named = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = classes.join(named, "component").select("fp", "component_id")
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def one_of_each_class(
    docs: DataFrame,
    distance: int = DISTANCE,
    blocks: int | None = None,
    shingle_words: int = SHINGLE_WORDS,
    grid_rows: int = GRID_ROWS,
) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: that of its smallest ``doc_id``.

    Rows that share this id are told apart by fingerprint and text, and of rows with one id and text
    one stays. Rows without id come last, so a class without any id keeps the row of its smallest
    fingerprint and text. Only ids and hashes are ranked; the texts move once, to meet the row that stays.
    """
    marked = _marked(docs, shingle_words)
    classes = _fingerprint_classes(marked, distance, blocks, grid_rows).select("fp", "component")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "hash")
    of_fp = marked.groupBy("fp").agg(F.min(order).alias("first"))
    firsts = of_fp.join(classes, "fp").groupBy("component").agg(F.min("first").alias("first"))
    keepers = stage(firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash")), "keepers")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    kept = rows.join(keepers, same)
    if marked.groupBy("doc_id", "hash").count().where("count > 1").isEmpty():
        return kept.select("row.*")
    nth = F.row_number().over(Window.partitionBy("doc_id", "hash").orderBy(F.xxhash64("row")))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")
