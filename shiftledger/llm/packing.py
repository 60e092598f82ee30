"""Packing of documents into windows of fixed length by best-fit decreasing.

A document's ids are followed by one end id. Ids beyond full windows leave a rest below the window
length; full windows stand alone, and the rests are packed, longest first, each into the open window
with the least room that holds it. A segment tree over the room left finds that window.

Pieces are numbered where they are made and dealt by that number into bins of about ``BIN_PIECES``
pieces, each of which is packed for itself: no task holds more, however many rows share a document
or an id. Within a bin the order is (length, doc_id, start, checksum), so a lost task packs the same
way again. A null text is empty and gives one piece with the end id; repeated rows are packed as
often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .texts import as_bytes, giving_back

WINDOW = 4096
END_ID = 2
BIN_PIECES = 100_000
#: Words a worker remembers, some 40 bytes each.
CACHED_WORDS = 1_000_000
TOKENIZER = "word_bpe_49k.json"

#: Signs after a letter at the end of a word are tokens of their own, with or without a blank before.
_SIGNS = re.compile(rb"(?<=[a-z])([.,;:!?]+)(?=[\x20\x09-\x0D]|\Z)")


class _Words:
    """Ids by word, per worker, in arrays: sorted word hashes, and where each word's ids lie.

    Fresh words go to a short sorted run that is merged into the long one now and then. When that is
    full, words not met since the last time go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        none = np.empty(0, np.int64)
        self.runs = [(none.astype(np.uint64), none, none, np.empty(0, bool))] * 2
        self.store = np.empty(0, "<u4")

    def _add(self, run: int, more: tuple[np.ndarray, ...]) -> None:
        merged = [np.concatenate(x) for x in zip(self.runs[run], more)]
        order = np.argsort(merged[0], kind="stable")
        self.runs[run] = tuple(x[order] for x in merged)

    def _shrink(self) -> None:
        keys, begin, size, used = self.runs[0]
        keys, begin, size = keys[used], begin[used], size[used]
        ends = np.cumsum(size)
        self.store = self.store[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
        self.runs[0] = (keys, ends - size, size, np.zeros(len(keys), bool))

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of the ids of each word in ``store``."""
        if len(self.runs[1][0]) > CACHED_WORDS // 8:
            self._add(0, self.runs[1])
            self.runs[1] = tuple(x[:0] for x in self.runs[1])
            if len(self.runs[0][0]) > CACHED_WORDS:
                self._shrink()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        begin, size = np.zeros(len(words), np.int64), np.full(len(words), -1)
        for keys, its_begin, its_size, used in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                here = keys[at] == hashes
                begin[here], size[here] = its_begin[at[here]], its_size[at[here]]
                used[at[here]] = True
        fresh = np.flatnonzero(size < 0)
        if len(fresh):
            ids = []
            for lo in range(0, len(fresh), 10_000):
                part = [words[i].decode() for i in fresh[lo : lo + 10_000].tolist()]
                ids += [array("I", e.ids) for e in self.model.encode_batch_fast(part, add_special_tokens=False)]
            size[fresh] = np.fromiter(map(len, ids), np.int64, len(ids))
            begin[fresh] = len(self.store) + np.cumsum(size[fresh]) - size[fresh]
            self.store = np.concatenate((self.store, np.frombuffer(b"".join(ids), "<u4")))
            self._add(1, (hashes[fresh], begin[fresh], size[fresh], np.ones(len(fresh), bool)))
        return begin, size


_loaded: dict[str, _Words] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _plain(text: bytes) -> bytes:
    """The same tokens from fewer different words: A-Z lower-cased, signs cut off.

    The tokenizer lower-cases anyway, but for its special tokens; texts that may hold one stay.
    """
    return text if b"<|" in text else _SIGNS.sub(rb" \1", text.lower())


def token_ids(texts: list[bytes], tokenizer: str) -> list[np.ndarray]:
    """Ids of each text, by a lower-casing tokenizer whose tokens never span ASCII white space.

    Every distinct piece between white space is encoded once and looked up from then on.
    """
    if tokenizer not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[tokenizer] = _Words(tokenizer if Path(tokenizer).is_absolute() else tokenizer_path(tokenizer))
    pieces = [_plain(t).split() for t in texts]
    counts = [len(p) for p in pieces]
    flat = pa.array(chain.from_iterable(pieces), pa.binary(), size=sum(counts)).dictionary_encode()
    begins, lengths = _loaded[tokenizer].ids(flat.dictionary.to_pylist())
    store = _loaded[tokenizer].store
    index = flat.indices.to_numpy()
    n = lengths[index]
    ends = np.cumsum(n)
    at = np.repeat(begins[index] - (ends - n), n) + np.arange(int(n.sum()))
    all_ids = store[at]
    word_ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
    return [all_ids[a:b] for a, b in zip(word_ends[:-1].tolist(), word_ends[1:].tolist())]


#: Texts cut into words at once.
SLICE_BYTES = 1 << 21
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, nth bigint"


def _piece_batches(window: int, end_id: int, tokenizer: str):
    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE_BYTES):
                    size += len(texts[hi])
                    hi += 1
                rows = []
                for doc, found in zip(ids[lo:hi], token_ids(texts[lo:hi], tokenizer)):
                    tokens = np.append(found, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(tokens), window):
                        piece = tokens[start : start + window]
                        rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens), nth))
                        nth += 1
                lo = hi
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"],
                )

    return cut


class RoomTree:
    """A segment tree over room left; a leaf holds the number of open windows with that room."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        at = self.size + room
        while at:
            self.open[at] += change
            at >>= 1

    def tightest(self, need: int) -> int:
        """The least room of an open window that is ``need`` or more, -1 if there is none."""
        at = self.size + need
        if self.open[at]:
            return need
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return -1


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length, in the given order; windows are numbered as they open."""
    tree = RoomTree(window)
    rooms: dict[int, list[int]] = {}
    opened = 0
    windows, offsets = [], []
    for length in lengths:
        room = tree.tightest(length)
        if room < 0:
            room, its = window, opened
            opened += 1
        else:
            its = rooms[room].pop()
            tree.add(room, -1)
        windows.append(its)
        offsets.append(window - room)
        left = room - length
        if left:
            rooms.setdefault(left, []).append(its)
            tree.add(left, 1)
    return windows, offsets


_ROOM_FOR_WINDOWS = 1 << 24


def _pack_bin(window: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("doc_tokens", "ascending")]
        )
        windows, offsets = best_fit(table.column("length").to_pylist(), window)
        first = pc.multiply(table.column("bin"), _ROOM_FOR_WINDOWS)
        return pa.table(
            {
                **{c: table.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")},
                "sequence_id": pc.add(first, pa.array(windows, pa.int64())),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    return pack


def pack_documents(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    tokenizer: str = TOKENIZER,
    bin_pieces: int = BIN_PIECES,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` names a file that every worker has: a path, or a name of the tokenizers' folder.
    """
    pieces = stage(
        docs.select("doc_id", "text")
        .mapInArrow(_piece_batches(window, end_id, tokenizer), _PIECES)
        .withColumn("part", F.spark_partition_id()),
        "pieces",
    )
    bins = -(-pieces.count() // bin_pieces)
    bin_ = F.pmod(F.xxhash64("part", "nth"), F.lit(max(1, bins)))
    return (
        pieces.withColumn("bin", bin_)
        .groupBy("bin")
        .applyInArrow(
            _pack_bin(window),
            "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        )
    )
