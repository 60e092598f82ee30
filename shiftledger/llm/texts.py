"""Texts of Arrow batches as byte arrays: words, lines and hashes without a loop per word.

Words are runs of anything but blank and U+0009 to U+000D. All of these are single bytes in
UTF-8, so words are cut on bytes and no text is decoded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def give_back() -> None:
    """Return freed memory to the machine: workers live on after their tasks, beside the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def giving_back(work):
    """A function over Arrow batches that returns its memory when it ends, its own frame included."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text. What earlier batches held is given back."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        kind = column.type
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``limit`` bytes together, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each ended by a line feed, and where each begins (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return data, begins


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word of ``joined`` data."""
    inside = np.empty(len(data) + 1, dtype=np.int8)
    inside[0] = 0
    inside[1:] = ~SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, made longer when needed."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))

        def powers(base: int) -> np.ndarray:
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        _powers, _inverses = powers(_P), powers(_P_INVERSE)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte values times powers: any span's polynomial is a difference of two."""
    powers, _ = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes in any text."""
    _, inverses = _tables(len(sums))
    return mix((sums[ends] - sums[begins]) * inverses[begins])


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(first * np.uint64(0xC2B2AE3D27D4EB4F) + second)


def text_of(begins: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Number of the text that holds each position."""
    return np.searchsorted(begins, positions, side="right") - 1
