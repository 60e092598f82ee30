"""Alignment of two tokenizers over the same bytes, by pointer jumping.

A text is cut into tokens by two tokenizers, A (byte-level BPE) and B (pieces with byte fallback). Every
token points to the farthest-right token that it overlaps; where none reaches farther than itself, an
A token and a B token end together, and that A token is its component's terminal. Doubling all pointers
at once (``next = next[next]``) until nothing changes brings every token to its terminal, which labels
its group. Groups are the finest runs of bytes that both tokenizers cut out alike.

Neither tokenizer has a token over a cut in front of a run of blanks, line feeds and tabs that follows
another character (A splits there; no piece of B holds a blank behind another character, nor a line feed
or tab). Texts are cut there into chunks, and of the chunks of a batch each distinct one is encoded,
aligned and written out once; a text is the sum of its chunks. A text without such cuts is one chunk.

How often an id pair is linked is counted over all texts, from pairs summed within each text. The table
of pairs is bounded by the vocabularies, whatever the input; it is broadcast up to ``BROADCAST_PAIRS``
pairs and joined beyond.

Null and empty texts, and texts whose tokens of A or B do not spell them (U+2581, which B reads as a
blank), have no tokens. Repeated rows count as often as they occur; a null ``doc_id`` is kept; other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .packing import tokenizer_path
from .texts import as_bytes, giving_back, slices

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Rows of the table of id pairs that are broadcast at most, 17 bytes each.
BROADCAST_PAIRS = 2_000_000
SLICE_BYTES = 1 << 22

_CHUNK = re.compile(rb"[ \n\t]*[^ \n\t]+|[ \n\t]+")
# fixed values: white space of Unicode but for blank, line feed and tab, and control characters
_OTHER_SPACE = (
    rb"[\x00-\x08\x0b-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_ODD = re.compile(_OTHER_SPACE)
_ODD_END = re.compile(rb"(?:" + _OTHER_SPACE + rb")\Z")


@dataclass
class Spelling:
    """The bytes of every id of a vocabulary, end to end."""

    data: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Spelling:
        sizes = np.array([len(e) for e in entries], np.int64)
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_ranges(self.begins[ids], self.sizes[ids])]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others as letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in plain}
    return found | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class _ByteBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        letters = byte_of_letter()
        special = set(self.model.get_added_tokens_decoder())
        entries = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            entries[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        self.spelling = Spelling.of(entries)

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode() for c in chunks]
        found = []
        for lo in range(0, len(texts), 20_000):
            found += [e.ids for e in self.model.encode_batch_fast(texts[lo : lo + 20_000], add_special_tokens=False)]
        return found


class _Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelling = Spelling.of(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        )
        # a line feed before a chunk without leading blank: the blank that the model adds goes with it
        self.lead = len(self.model.encode("\n"))

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [c[1:].decode() if c[:1] == b" " else "\n" + c.decode() for c in chunks]
        bare = [c[:1] != b" " for c in chunks]
        # a chunk of one blank is an empty text to the model, which then adds nothing
        blank = self.model.encode(" a")[:1]
        found = self.model.encode(texts, num_threads=1)
        return [blank if not t else ids[self.lead :] if b else ids for t, ids, b in zip(texts, found, bare)]


_loaded: dict[tuple, object] = {}


def _tokenizer(kind: type, name: str):
    if (kind, name) not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[kind, name] = kind(name if os.path.isabs(name) else tokenizer_path(name))
    return _loaded[kind, name]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring ends."""
    return np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))[ends])


def chunks_of(line: bytes) -> list[bytes]:
    """A line cut in front of runs of blanks, line feeds and tabs that follow a character that is no space."""
    chunks = _CHUNK.findall(line)
    if not _ODD.search(line):
        return chunks
    whole = chunks[:1]
    for chunk in chunks[1:]:
        if _ODD_END.search(whole[-1][-3:]):
            whole[-1] += chunk
        else:
            whole.append(chunk)
    return whole


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal (an A token) of each A and each B token, by pointer jumping.

    Both rows of tokens cover the same bytes from 0 without gaps; tokens are not empty.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    # the last token of the other row that begins before this one ends
    far_of_a = np.searchsorted(np.concatenate(([0], ends_b[:-1])), ends_a, side="left") - 1
    far_of_b = np.searchsorted(np.concatenate(([0], ends_a[:-1])), ends_b, side="left") - 1
    itself = np.arange(n_a)
    to_b = ends_b[far_of_a] > ends_a if n_a else np.empty(0, bool)
    follow = np.concatenate((np.where(to_b, n_a + far_of_a, itself), far_of_b))
    while True:
        farther = follow[follow]
        if (farther == follow).all():
            return follow[:n_a], follow[n_a : n_a + n_b]
        follow = farther


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def _spelt(spelling: Spelling, ids: np.ndarray, counts: np.ndarray, chunks: list[bytes]) -> np.ndarray:
    """Whether each chunk's ids spell it, byte by byte."""
    ends = np.concatenate(([0], np.cumsum(spelling.sizes[ids])))[np.concatenate(([0], np.cumsum(counts)))]
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    same = np.diff(ends) == sizes
    text = np.frombuffer(b"".join(chunks), np.uint8)
    begins = np.cumsum(sizes) - sizes
    mine = _ranges(ends[:-1][same], sizes[same])
    theirs = _ranges(begins[same], sizes[same])
    wrong = spelling.joined(ids)[mine] != text[theirs]
    bad = np.repeat(np.flatnonzero(same), sizes[same])[wrong]
    same[bad] = False
    return same


@dataclass
class Aligned:
    """Chunks side by side: per chunk its counts, groups in writing and id pairs; ``ok`` if ids spell it."""

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    written: list[bytes]
    pairs: np.ndarray
    pair_begins: np.ndarray
    n_pairs: np.ndarray


_digits: list = []


def _numbers(most: int) -> Spelling:
    if not _digits or len(_digits[0].sizes) <= most:
        _digits[:] = [Spelling.of([str(i).encode() for i in range(most + 1)])]
    return _digits[0]


def align_chunks(a: _ByteBPE, b: _Pieces, chunks: list[bytes]) -> Aligned:
    ids_a, n_a = _flat(a.encode(chunks))
    ids_b, n_b = _flat(b.encode(chunks))
    ok = _spelt(a.spelling, ids_a, n_a, chunks) & _spelt(b.spelling, ids_b, n_b, chunks)
    ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
    n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
    ends_a, ends_b = np.cumsum(a.spelling.sizes[ids_a]), np.cumsum(b.spelling.sizes[ids_b])
    label_a, label_b = group_labels(ends_a, ends_b)
    terminals = np.flatnonzero(label_a == np.arange(len(label_a)))
    group_a, group_b = np.searchsorted(terminals, label_a), np.searchsorted(terminals, label_b)
    of_chunk = np.repeat(np.arange(len(chunks)), n_a)
    n_groups = np.bincount(of_chunk[terminals], minlength=len(chunks))

    # links: tokens that end on the same byte
    at = np.searchsorted(ends_b, ends_a)
    linked = np.flatnonzero(ends_b[np.minimum(at, max(0, len(ends_b) - 1))] == ends_a) if len(ends_b) else np.empty(0, np.int64)
    pairs = (ids_a[linked] << 32) | ids_b[at[linked]]
    n_pairs = np.bincount(of_chunk[linked], minlength=len(chunks))

    # a1,a2|b1;a3|b2,b3; in one array: tokens by group, A before B, each with the sign behind it
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    ids = np.concatenate((ids_a, ids_b))[order]
    side = np.concatenate((2 * group_a, 2 * group_b + 1))[order]
    numbers = _numbers(max(len(a.spelling.sizes), len(b.spelling.sizes)))
    sizes = numbers.sizes[ids] + 1
    ends = np.cumsum(sizes)
    line = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    signs = np.full(len(ids), ord(","), np.uint8)
    last = np.flatnonzero(np.diff(side, append=-1) != 0)
    signs[last] = np.where(side[last] % 2 == 0, ord("|"), ord(";"))
    line[ends - 1] = signs
    line[_ranges(ends - sizes, sizes - 1)] = numbers.joined(ids)
    chunk_ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    blob = line.tobytes()
    written = [blob[x:y] for x, y in zip(chunk_ends[:-1].tolist(), chunk_ends[1:].tolist())]
    return Aligned(ok, n_a, n_b, n_groups, written, pairs, np.cumsum(n_pairs) - n_pairs, n_pairs)


def align_texts(a: _ByteBPE, b: _Pieces, texts: list[bytes]) -> dict[str, pa.Array]:
    """Counts, groups and summed links of each text."""
    cut = [chunks_of(b" " + t) if t else [] for t in texts]
    counts = np.array([len(c) for c in cut], np.int64)
    flat = pa.array(chain.from_iterable(cut), pa.large_binary(), size=int(counts.sum())).dictionary_encode()
    del cut
    its = align_chunks(a, b, flat.dictionary.to_pylist())
    index = flat.indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), counts)
    lost = np.bincount(text[~its.ok[index]], minlength=len(texts)) > 0
    kept = ~lost[text]
    index, text = index[kept], text[kept]

    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    digests = []
    numbers = index.tolist()
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
        groups = b"".join([its.written[i] for i in numbers[lo:hi]])[:-1]
        digests.append(hashlib.sha256(groups).hexdigest() if groups else "")

    pairs, number = np.unique(its.pairs, return_inverse=True)
    many = its.n_pairs[index]
    links = number[_ranges(its.pair_begins[index], many)]
    key, times = np.unique(np.repeat(text, many) * max(1, len(pairs)) + links, return_counts=True)
    of_text, pair = np.divmod(key, max(1, len(pairs)))
    offsets = pa.array(np.searchsorted(of_text, np.arange(len(texts) + 1)).astype(np.int32))
    linked = pa.StructArray.from_arrays([pa.array(pairs[pair]), pa.array(times, pa.int64())], ["pair", "times"])
    return {
        "n_a": pa.array(_sums(its.n_a[index], ends)),
        "n_b": pa.array(_sums(its.n_b[index], ends)),
        "n_groups": pa.array(_sums(its.n_groups[index], ends)),
        "n_links": pa.array(_sums(many, ends)),
        "groups_sha256": pa.array(digests, pa.string()),
        "links": pa.ListArray.from_arrays(offsets, linked),
    }


_ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "links array<struct<pair: bigint, times: bigint>>, nth bigint"
)


def _align_batches(tokenizer_a: str, tokenizer_b: str):
    @giving_back
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizer(_ByteBPE, tokenizer_a), _tokenizer(_Pieces, tokenizer_b)
        nth = 0
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for lo, hi in slices(texts, SLICE_BYTES):
                found = align_texts(a, b, texts[lo:hi])
                found = {"doc_id": batch.column("doc_id").slice(lo, hi - lo)} | found
                found["nth"] = pa.array(np.arange(nth, nth + hi - lo))
                nth += hi - lo
                yield pa.RecordBatch.from_arrays(list(found.values()), list(found))

    return align


_SUMMED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _sum_batches(table):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = table.value
        for batch in batches:
            links = batch.column("links")
            ends = np.concatenate(([0], np.cumsum(links.value_lengths().to_numpy())))
            pair, times = (x.to_numpy(zero_copy_only=False) for x in links.flatten().flatten())
            at = np.searchsorted(keys, pair)
            given = {c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            given |= {"n_best": pa.array(_sums(times * best[at], ends)), "count_sum": pa.array(_sums(times * counts[at], ends))}
            given["groups_sha256"] = batch.column("groups_sha256")
            yield pa.RecordBatch.from_arrays(list(given.values()), list(given))

    return add


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A's id times 2**32 plus B's), ``n`` and whether it is its B id's highest; staged."""
    counted = aligned.select(F.inline("links")).groupBy("pair").agg(F.sum("times").alias("n"))
    # a partition is one B id: no more rows than A has ids
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return stage(counted.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best")), "pair-counts")


def align_documents(
    docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    The tokenizers are files that every worker has: paths, or names of the tokenizers' folder.
    """
    aligned = stage(
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(_align_batches(tokenizer_a, tokenizer_b), _ALIGNED)
        .withColumn("part", F.spark_partition_id()),
        "aligned",
    )
    counts = pair_counts(aligned)
    if counts.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        table = counts.orderBy("pair").toArrow()
        arrays = tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
        sent = docs.sparkSession.sparkContext.broadcast(arrays)
        return aligned.drop("part", "nth").mapInArrow(_sum_batches(sent), _SUMMED)
    times = F.col("times")
    sums = (
        aligned.select("part", "nth", F.inline("links"))
        .join(counts, "pair")
        .groupBy("part", "nth")
        .agg(F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("n")).alias("count_sum"))
    )
    nothing = F.lit(0).cast("bigint")
    return aligned.drop("links").join(sums, ["part", "nth"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", nothing).alias("n_best"), F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256",
    )
