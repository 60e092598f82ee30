"""Removal of repeated byte strings by suffix order and longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a
smaller id, or before it in the same document. Strings never cross documents, and all are judged on
the input. What has to meet is brought together by content:

1. Every string belongs to its *anchor*, the smallest-hashed ``GRAM``-byte piece in it. Neighbouring
   strings share an anchor; they form a *segment*. Equal strings have equal anchors.
2. Segments that are equal as a whole are settled by their hash: all but the first are repeats.
   Each task does so for what it reads before anything is shuffled.
3. Different segments with one anchor may still share strings. Only the first copy of each is
   fetched; a suffix order over these and its longest-previous-factor array tell which strings
   occur earlier.

Anchors that many different segments share (found on a sample, which only chooses the way) are split
into their single strings, so that no group holds an unbounded number of segments.

A null text is empty; texts below ``length`` bytes stay whole. Rows with a null ``doc_id`` count as
last. Rows that share an id are ordered by a hash of their text, and equal rows count as one
document and have the same result. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .texts import SLICE_BYTES, as_bytes, give_back, giving_back, joined, pair_hashes, prefix_sums, slices, span_hashes

LENGTH = 100
GRAM = 32
#: An anchor is split if it has more than this share of the anchors of the sample ...
HOT_SHARE = 1e-5
#: ... and more rows in it than this. The list has at most 1 / HOT_SHARE entries.
HOT_ROWS = 20
SAMPLE_OF = 64

_DOC = ("doc_id", "tag")


# -- anchors and segments ----------------------------------------------------------------------

def _first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of ``width`` values from each position on."""
    best, at = values, np.arange(len(values), dtype=np.int64)
    cover = 1
    while cover < width:
        step = min(cover, width - cover)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, best[step:], best[:-step])
        cover += step
    return at


def segments_of(
    data: np.ndarray, begins: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of ``joined`` texts: anchor key, segment hash, begin, number of strings; and sums."""
    n = len(data)
    sums = prefix_sums(data)
    empty = np.empty(0, np.int64)
    if n < length + 1:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, sums
    pieces = np.arange(n - gram + 1)
    keys = span_hashes(sums, pieces, pieces + gram)
    anchor = _first_smallest(keys, length - gram + 1)
    # strings within a text begin where the text still has ``length`` bytes, its line feed not counted
    text_ends = np.repeat(begins[1:] - 1, np.diff(begins))
    strings = np.flatnonzero(np.arange(len(anchor)) + length <= text_ends[: len(anchor)])
    if not len(strings):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, sums
    own = anchor[strings]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    start = strings[first]
    count = np.diff(np.concatenate((first, [len(strings)])))
    whole = span_hashes(sums, start, start + count - 1 + length)
    place = (own[first] - start).astype(np.uint64)
    return keys[own[first]], pair_hashes(whole, place), start, count, sums


def _id_order(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers, and whether they are null."""
    null = np.asarray(ids.is_null())
    return np.asarray(ids.fill_null(0)).astype(np.int64), null


def merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans by row, as maximal spans; spans of one row that touch are one."""
    if not len(row):
        return row, start, stop
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    # a running maximum by row: rows are lifted above one another
    lift = (row - row[0]) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    fresh = np.concatenate(([True], (start[1:] + lift[1:] > reach[:-1]) | (row[1:] != row[:-1])))
    at = np.flatnonzero(fresh)
    last = np.concatenate((at[1:], [len(row)])) - 1
    return row[at], start[at], reach[last] - lift[last]


_SEGMENT_SCHEMA = "key bigint, seg bigint, doc_id bigint, tag bigint, at bigint"


def _segment_batches(length: int, gram: int, hot: np.ndarray):
    """First copies of the segments of each Arrow batch, and the spans of all later ones.

    ``at`` holds the begin and the number of strings. A span has no strings, and its length in ``seg``.
    """

    @giving_back
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, null = _id_order(batch.column("doc_id"))
            tags = batch.column("tag").to_numpy()
            texts = as_bytes(batch.column("text"))
            found = []
            for lo, hi in slices(texts):
                data, begins = joined(texts[lo:hi])
                key, seg, start, count, sums = segments_of(data, begins, length, gram)
                row = np.searchsorted(begins, start, side="right") - 1
                if len(hot):
                    split = np.isin(key, hot)
                    if split.any():
                        n = count[split]
                        single = np.repeat(start[split], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                        # kept apart from anchor keys by the pairing
                        window = pair_hashes(span_hashes(sums, single, single + length), np.uint64(length))
                        key = np.concatenate((key[~split], window))
                        seg = np.concatenate((seg[~split], np.zeros(len(window), np.uint64)))
                        row = np.concatenate((row[~split], np.repeat(row[split], n)))
                        start = np.concatenate((start[~split], single))
                        count = np.concatenate((count[~split], np.ones(len(window), np.int64)))
                found.append((key, seg, row + lo, start - begins[row], count))
            if not found:
                continue
            key, seg, row, start, count = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((start, tags[row], ids[row], null[row], seg, key))
            key, seg, row, start, count = (x[order] for x in (key, seg, row, start, count))
            again = np.zeros(len(key), dtype=bool)
            again[1:] = (key[1:] == key[:-1]) & (seg[1:] == seg[:-1])
            span_row, span_start, span_stop = merged(row[again], start[again], start[again] + count[again] - 1 + length)
            keep = ~again
            out_row = np.concatenate((row[keep], span_row))
            # a span only passes through the shuffle; its own hash deals it out
            span_key = pair_hashes(ids[span_row].view(np.uint64), span_start.astype(np.uint64))
            columns = [
                pa.array(np.concatenate((key[keep], span_key)).view(np.int64)),
                pa.array(np.concatenate((seg[keep].view(np.int64), span_stop - span_start))),
                pa.array(ids[out_row], mask=null[out_row]),
                pa.array(tags[out_row]),
                pa.array(np.concatenate((start[keep] << 8 | count[keep], span_start << 8))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "seg", "doc_id", "tag", "at"])

    return segment


def _settle_batches(length: int):
    """Over rows in the order of key, segment and document: spans, and first copies to compare.

    Only the first row of the current anchor is held back, until a second segment of it appears.
    """

    @giving_back
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_seg = held = None
        several = False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, seg, at = (batch.column(c).to_numpy() for c in ("key", "seg", "at"))
            start, count = at >> 8, at & 255
            passing = count == 0
            new_key = np.concatenate(([last_key is None or key[0] != last_key], key[1:] != key[:-1]))
            new_seg = new_key | np.concatenate(([last_seg is None or seg[0] != last_seg], seg[1:] != seg[:-1]))
            first = np.flatnonzero(new_seg & ~passing)
            # firsts by anchor; the anchor that came over from the batch before has number 0
            group = np.cumsum(new_key)[first]
            size = np.bincount(group, minlength=int(new_key.sum()) + 1)
            over = np.array([several or (held is not None and size[0] > 0)])
            many = np.concatenate((over, size[1:] > 1))
            send = [held] if held is not None and size[0] > 0 else []
            if send or new_key.any():
                held = None
            several = bool(many[-1])
            compare = first[many[group]]
            if not several and size[-1] == 1 and new_key.any():
                held = batch.slice(int(first[-1]), 1)
            stop = np.where(passing, start + seg, start + count - 1 + length)
            spans = np.flatnonzero(passing | ~new_seg)
            pick = np.concatenate((spans, compare))
            none = np.zeros(len(pick), dtype=bool)
            none[: len(spans)] = True
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[pick], mask=none),
                    batch.column("doc_id").take(pa.array(pick)),
                    batch.column("tag").take(pa.array(pick)),
                    pa.array(start[pick]),
                    pa.array(stop[pick]),
                ],
                ["key", "doc_id", "tag", "start", "stop"],
            )
            for row in send:
                begin, n = int(row.column("at")[0].as_py()) >> 8, int(row.column("at")[0].as_py()) & 255
                yield pa.RecordBatch.from_arrays(
                    [row.column("key"), row.column("doc_id"), row.column("tag"),
                     pa.array([begin]), pa.array([begin + n - 1 + length])],
                    ["key", "doc_id", "tag", "start", "stop"],
                )
            last_key, last_seg = key[-1], seg[-1]

    return settle


# -- suffix order ------------------------------------------------------------------------------

def suffix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each position ``at`` on; bytes beyond the end are zero.

    Ranks of 8 bytes come from the bytes themselves, those of twice as many from pairs of ranks.
    """
    padded = np.concatenate((data, np.zeros(2 * length + 16, np.uint8)))
    n = len(data) + length
    value = np.zeros(n, dtype=np.uint64)
    for i in range(min(8, length)):
        value = value << np.uint64(8) | padded[i : i + n]
    width = min(8, length)
    rank = np.unique(value, return_inverse=True)[1].astype(np.uint64)
    while width < length:
        step = min(width, length - width)
        n = len(rank) - step
        pair = rank[:n] << np.uint64(32) | rank[step : step + n]
        width += step
        if width == length:
            return np.unique(pair[at], return_inverse=True)[1]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    return rank[at].astype(np.int64)


def longest_previous_factor(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each text position, the longest match with one that begins earlier.

    ``order`` has the positions in suffix order, ``lcp[i]`` what ``order[i - 1]`` and ``order[i]``
    have in common. The earlier positions that match longest are the previous and the next smaller
    position in the order; a stack finds both.
    """
    best = dict.fromkeys(order.tolist(), 0)
    stack: list[tuple[int, int]] = []
    for position, common in zip([*order.tolist(), -1], [*lcp.tolist(), 0]):
        while stack and stack[-1][0] > position:
            top, its = stack.pop()
            # ``its`` is shared with the previous smaller one, ``common`` with the next smaller one
            best[top] = max(its, common)
            common = min(its, common)
        if position >= 0:
            stack.append((position, common))
    return np.array([best[p] for p in sorted(best)], dtype=np.int64)


def repeated_windows(
    data: np.ndarray, begins: np.ndarray, counts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans ``(row, start, stop)`` of the strings of each segment that occur in an earlier segment.

    Segment ``i`` begins at ``begins[i]`` and has ``counts[i]`` strings.
    """
    total = int(counts.sum())
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    position = begins[row] + inside
    rank = suffix_ranks(data, position, length)
    order = np.argsort(rank, kind="stable")
    ranked = rank[order]
    same = ranked[1:] == ranked[:-1]
    # strings alone in the order have no factor of the full length
    in_run = np.concatenate((same, [False])) | np.concatenate(([False], same))
    order, ranked = order[in_run], ranked[in_run]
    lcp = np.zeros(len(order), dtype=np.int64)
    lcp[1:] = np.where(ranked[1:] == ranked[:-1], length, 0)
    factor = longest_previous_factor(order, lcp)
    later = np.sort(order)[factor >= length]
    return merged(row[later], inside[later], inside[later] + length)


def _compare_batches(length: int):
    """Over segments in the order of key and document: spans of strings that occur earlier."""

    @giving_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = rows.column("key").to_numpy()
            texts = as_bytes(rows.column("bytes"))
            lo, size = 0, 0
            ends = np.flatnonzero(np.concatenate((keys[1:] != keys[:-1], [True]))) + 1
            before = 0
            for end in ends.tolist():
                size += sum(map(len, texts[before:end]))
                before = end
                if size >= SLICE_BYTES or end == len(texts):
                    data, begins = joined(texts[lo:end])
                    counts = np.diff(begins) - length  # its line feed makes up for the 1
                    row, start, stop = repeated_windows(data, begins[:-1], counts, length)
                    if len(row):
                        pick = pa.array(row + lo)
                        base = rows.column("start").to_numpy()[row + lo]
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows.column("doc_id").combine_chunks().take(pick),
                                rows.column("tag").combine_chunks().take(pick),
                                pa.array(base + start),
                                pa.array(base + stop),
                            ],
                            ["doc_id", "tag", "start", "stop"],
                        )
                    lo, size = end, 0

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if not table.num_rows:
                continue
            keys = table.column("key").to_numpy()
            whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            if whole:
                yield from out(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None and held.num_rows:
            yield from out(held)

    return compare


# -- plans -------------------------------------------------------------------------------------

def _packed(text: Column) -> Column:
    """Compressed bytes of a text, which is what joins with it move."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=3)
        packed = pa.array([squeeze.compress(t) for t in as_bytes(texts)], pa.binary())
        give_back()
        return packed

    return pack(text)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


@giving_back
def _fetch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments asked for in each document."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = _unpack(batch.column("packed")[i].as_py())
            wanted = batch.column("wanted")[i].values
            start, stop, key = (wanted.field(c).to_numpy() for c in ("start", "stop", "key"))
            n = len(start)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array([batch.column("doc_id")[i].as_py()] * n, pa.int64()),
                    pa.array([batch.column("tag")[i].as_py()] * n, pa.int64()),
                    pa.array(start),
                    pa.array([text[a:b] for a, b in zip(start.tolist(), stop.tolist())], pa.binary()),
                ],
                ["key", "doc_id", "tag", "start", "bytes"],
            )


def _by_document(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """One row per document with all its spans; their number is bounded by the document's length."""
    return rows.groupBy(
        F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag")
    ).agg(F.collect_list(F.struct(*columns)).alias(name))


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tag") == F.col("_tag"))


def _identified(docs: DataFrame) -> tuple[Column, DataFrame]:
    """What tells rows with one id apart (zero if ids are unique, else a hash of the text), and the
    documents ``doc_id, tag, text`` without equal rows."""
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if shared.isEmpty():
        tag = F.lit(0).cast("bigint")
        return tag, docs.select("doc_id", tag.alias("tag"), "text")
    tag = F.xxhash64("text")
    return tag, docs.select("doc_id", tag.alias("tag"), "text").dropDuplicates(list(_DOC))


def repeated_spans(
    rows: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    sample_of: int = SAMPLE_OF,
) -> DataFrame:
    """Spans ``doc_id, tag, start, stop`` (bytes) that go, of documents ``doc_id, tag, text``.

    ``doc_id`` and ``tag`` together are unique. Spans may overlap; they are staged.
    """
    if not 8 <= gram < length or length - gram >= 255:
        raise ValueError("the gram has to be shorter than the string, by less than 255")
    none = np.empty(0, np.uint64)

    def segments(of: DataFrame, hot: np.ndarray) -> DataFrame:
        return of.mapInArrow(_segment_batches(length, gram, hot), _SEGMENT_SCHEMA)

    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(sample_of)) == 0)
    counted = stage(
        segments(sample, none).where("(at & 255) > 0").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1),
        "anchors",
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    bound = max(hot_rows, hot_share * total)
    hot = [r.key for r in counted.where(F.col("n") > bound).select("key").collect()]
    hot_keys = np.array(sorted(hot), dtype=np.int64).view(np.uint64)

    settled = stage(
        segments(rows, hot_keys)
        .repartition("key")
        .sortWithinPartitions("key", "seg", F.col("doc_id").asc_nulls_last(), "tag", "at")
        .mapInArrow(_settle_batches(length), "key bigint, doc_id bigint, tag bigint, start bigint, stop bigint"),
        "settled",
    )
    wanted = _by_document(settled.where("key IS NOT NULL"), "wanted", "start", "stop", "key")
    fetched = (
        rows.select("doc_id", "tag", _packed(F.col("text")).alias("packed"))
        .join(wanted, _same_document())
        .select("doc_id", "tag", "packed", "wanted")
        .mapInArrow(_fetch_batches, "key bigint, doc_id bigint, tag bigint, start bigint, bytes binary")
    )
    compared = (
        fetched.repartition("key")
        .sortWithinPartitions("key", F.col("doc_id").asc_nulls_last(), "tag", "start")
        .mapInArrow(_compare_batches(length), "doc_id bigint, tag bigint, start bigint, stop bigint")
    )
    return settled.where("key IS NULL").select(*_DOC, "start", "stop").union(stage(compared, "compared"))


def _spans_of(spans: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    if not spans.is_valid:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, stop = (spans.values.field(c).to_numpy() for c in ("start", "stop"))
    return merged(np.zeros(len(start), np.int64), start, stop)[1:]


def _kept(text: bytes, start: np.ndarray, stop: np.ndarray) -> bytes:
    edges = [0, *np.column_stack((start, stop)).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


_DIGEST = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>"


def _digest(packed: pa.Array, spans: pa.Array) -> pa.Array:
    rows = []
    for bytes_, found in zip(packed, spans):
        text = _unpack(bytes_.as_py())
        start, stop = _spans_of(found)
        kept = _kept(text, start, stop)
        rows.append((len(text), len(text) - len(kept), len(start), hashlib.sha256(kept).hexdigest()))
    size, gone, runs, digest = zip(*rows) if rows else ((), (), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
        ["n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for whole, found in zip(text, spans):
        if not found.is_valid:
            out.append(whole.as_py())
        else:
            out.append(_kept(whole.as_py().encode(), *_spans_of(found)).decode(errors="ignore"))
    cut = pa.array(out, pa.string())
    del out, text, spans
    give_back()
    return cut


def removal_digest(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    tag, rows = _identified(docs)
    spans = _by_document(repeated_spans(rows, **settings), "spans", "start", "stop")
    return (
        docs.select("doc_id", tag.alias("tag"), _packed(F.col("text")).alias("packed"))
        .join(spans, _same_document(), "left")
        .select("doc_id", F.arrow_udf(_digest, _DIGEST)("packed", "spans").alias("d"))
        .select("doc_id", "d.*")
    )


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text`` and ``n_chars`` (if there) counted anew.

    Where a cut leaves part of a character, that part goes too.
    """
    tag, rows = _identified(docs)
    spans = _by_document(repeated_spans(rows, **settings), "spans", "start", "stop")
    cut = (
        docs.select(F.struct("*").alias("row"), "doc_id", tag.alias("tag"), "text")
        .join(spans, _same_document(), "left")
        .select("row", F.arrow_udf(_cut, "string")("text", "spans").alias("cut"))
    )
    changed = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length("cut").cast("bigint"), F.col("row.n_chars"))
    return cut.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
