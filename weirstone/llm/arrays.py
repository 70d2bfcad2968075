"""Texts of an Arrow column as byte arrays, their words, and hashes of words and windows.

Everything here works on bounded slices of a column: numpy arrays over the bytes of some megabytes
of text, and over one text alone where that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

BATCH_ROWS = 1000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Separators of the word patterns: white space only, or all ASCII but digits and letters.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = True
NOT_WORD[[*range(48, 58), *range(97, 123)]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def bounded_batches(spark) -> None:
    """Hand rows to Python in batches of ``BATCH_ROWS`` at most, for this session.

    The default of 10,000 rows is meant for numbers; of documents it makes a batch of 30 MB and more,
    which both sides hold several times.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def release() -> None:
    """Give freed memory back to the system. Workers live on for other tasks and stages, and the
    allocators keep what one of them once needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if n > 8 << 20:  # one very long text: not kept
        return _powers.__wrapped__(n)
    return _powers(1 << max(16, (n - 1).bit_length()))  # every worker keeps these


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the ``n + 1`` offsets of its rows; a null row has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with at most ``limit`` bytes each, or one longer row."""
    _, offsets = text_buffer(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each row (``n + 1`` entries)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~separator[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1]] = False  # a row begins a word of its own
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside[1:]
    ends = np.unique(offsets[1:])
    after[ends[ends > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, offsets)


class Prefixes:
    """Hash of any window of a byte array from one running sum."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * self.up[: len(data)], out=self.sums[1:])

    def windows(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """64-bit hash of each window; equal content of equal length has an equal hash."""
        inner = (self.sums[stops] - self.sums[starts]) * self.down[starts]
        return mix(inner + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(word_hash: np.ndarray, first_word: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, and the row of each.

    A row with fewer words has one shingle of them all, a row without words none.
    """
    counts = np.diff(first_word)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    row = np.repeat(np.arange(len(counts)), made)
    if not len(row):
        return np.zeros(0, np.uint64), row
    begin = first_word[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made))
    room = counts[row]
    total = np.zeros(len(row), np.uint64)
    padded = np.concatenate([word_hash, np.zeros(size, np.uint64)])
    for j in range(size):
        factor = np.uint64((0x9E3779B97F4A7C15 * (2 * j + 3)) & ((1 << 64) - 1) | 1)
        total += np.where(j < room, mix(padded[begin + j] + np.uint64(j + 1)) * factor, np.uint64(0))
    return mix(total), row


class Lookup:
    """Positions of hashes in a fixed set; a table of bits turns most misses away cheaply."""

    def __init__(self, hashes: np.ndarray, bits: int = 20):
        self.hashes = np.unique(hashes)
        self.mask = np.uint64((1 << bits) - 1)
        self.present = np.zeros(1 << bits, bool)
        self.present[self.hashes & self.mask] = True

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``wanted`` are in the set (their positions), and where in ``hashes`` each is."""
        spot = np.flatnonzero(self.present[wanted & self.mask])
        if not len(spot):
            return spot, spot
        at = np.minimum(np.searchsorted(self.hashes, wanted[spot]), len(self.hashes) - 1)
        hit = self.hashes[at] == wanted[spot]
        return spot[hit], at[hit]
