"""Texts of an Arrow batch as byte arrays, and their words, without per-row Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE = 2_000_000
SLICE = 1 << 16  # bytes whose words are hashed at once

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets (one more than rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets (from 0) of runs of rows of about ``size`` bytes."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the row of each."""
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    space = _IS_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)  # a row begins here
    cut[offsets] = True
    after = np.concatenate([[True], space[:-1]]) | cut[:-1]
    before = np.concatenate([space[1:], [True]]) | cut[1:]
    starts = np.flatnonzero(~space & after)
    ends = np.flatnonzero(~space & before) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _powers(base: int, count: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < count:
        size = max(count, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * PIECE:  # beyond that a single long text would keep them in memory
            _POWERS[base] = have
    return have[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Sums of byte times power of place; ``span_hashes`` gets any span's hash from them."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(base, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hashes of the spans' bytes: a polynomial, shifted to place 0, then mixed."""
    shift = _powers(pow(base, -1, 1 << 64), len(sums))
    return mixed((sums[ends] - sums[starts]) * shift[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words in order of place, by slices, so that no sums of a whole long text are held."""
    out, first = np.empty(len(starts), dtype=np.uint64), 0
    while first < len(starts):
        low = starts[first]
        last = max(int(np.searchsorted(ends, low + SLICE, "right")), first + 1)
        own = slice(first, last)
        out[own] = span_hashes(prefix_sums(data[low : ends[last - 1]]), starts[own] - low, ends[own] - low)
        first = last
    return out


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words (of one row)."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:count].copy()
    for k in range(1, size):
        h = mixed(h * _MUL + words[k : k + count])
    return mixed(h + np.uint64(size))


class Lookup:
    """Finds 64-bit hashes in a sorted table, by their high bits."""

    def __init__(self, sorted_hashes: np.ndarray):
        self.hashes = sorted_hashes
        self.bits = max(4, int(len(sorted_hashes)).bit_length() + 1)
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.bucket = np.append(np.searchsorted(sorted_hashes, edges), len(sorted_hashes))
        self.fullest = int(np.diff(self.bucket).max())

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the table, and their place in it."""
        bucket = (hashed >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.bucket[bucket], self.bucket[bucket + 1]
        which, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(at < end)
        for _ in range(self.fullest):
            here = at[left]
            same = self.hashes[here] == hashed[left]
            which.append(left[same])
            places.append(here[same])
            at[left] += 1
            left = left[~same & (here + 1 < end[left])]
            if not len(left):
                break
        which, places = np.concatenate(which), np.concatenate(places)
        order = np.argsort(which, kind="stable")
        return which[order], places[order]
