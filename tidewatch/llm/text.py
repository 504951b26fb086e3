"""Words, hashes and n-gram sets of whole Arrow text columns, as vectors over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

import tidewatch.llm.memory  # noqa: F401 - applies in every worker that imports this

CHUNK_BYTES = 2 << 20  # texts are worked on in slices of about so many bytes; a longer text is one slice

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64), one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for positions below ``n``."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        base = np.full(size, _BASE, np.uint64)
        base[0] = 1
        inverse = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        _powers, _inverses = np.cumprod(base), np.cumprod(inverse)
    return _powers[:n], _inverses[:n]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each ``data[start:end]``: equal bytes give equal hashes wherever they stand."""
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * _FOLD)


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; no other byte changes."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of the first word of each row (one more entry than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[edges] = inside[edges]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    stop[before] = inside[before]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values, row borders ignored."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    count = len(values) - size + 1
    total = values[:count].copy()
    for k in range(1, size):
        total = total * _FOLD + values[k:k + count]
    return mix(total)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct n-gram hashes of each row, laid end to end, and the bounds of the rows.

    A row with fewer words than ``size`` has its whole sequence as its one n-gram; without words it has none.
    """
    starts, ends, firsts = word_spans(data, offsets)
    words = range_hashes(data, starts, ends)
    grams = windows(words, size)
    counts = np.diff(firsts)
    kept = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(kept)))
    out = np.empty(bounds[-1], np.uint64)
    for row in np.flatnonzero(counts):
        low, high, first, n = bounds[row], bounds[row + 1], firsts[row], counts[row]
        if n >= size:
            out[low:high] = grams[first:first + high - low]
            out[low:high].sort()
        else:
            out[low] = windows(words[first:first + n], int(n))[0] ^ np.uint64(n)
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][kept > 0]] = True
    sums = np.concatenate(([0], np.cumsum(fresh)))
    return out[fresh], sums[bounds]
