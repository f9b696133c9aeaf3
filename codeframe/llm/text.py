"""Words and shingles of whole Arrow columns as 64-bit hashes, in numpy.

A word is a run of bytes other than the blank and 0x09-0x0D. Its hash is a polynomial over a table of random 64-bit values,
mixed at the end, so that two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text handled at once; a longer text is handled alone and whole.
BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C13)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public SplitMix64 generator, elementwise."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_BYTE[SPACE] = 0
_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most BLOCK_BYTES of text, or of one longer text. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        end = min(end, len(column))
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``, and where each row's words begin (one more entry than rows)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    ink = ~SPACE[data]
    begin, stop = ink.copy(), ink.copy()
    begin[1:] &= ~ink[:-1]
    stop[:-1] &= ~ink[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    begin[edge] = ink[edge]
    stop[edge - 1] = ink[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    head = starts[0]
    lengths = np.diff(starts, append=len(data))
    place = np.arange(len(data) - head) - np.repeat(starts - head, lengths)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
        return mix(np.add.reduceat(_BYTE[data[head:]] * power[place], starts - head))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words; a row with fewer words has its whole sequence as one. With their bounds."""
    counts = np.diff(first)
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(many)])
    n = len(hashes)
    with np.errstate(over="ignore"):
        padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
        whole = np.zeros(n, np.uint64)
        for j in range(size):
            whole += padded[j: j + n] * _PLACE[j]
        row = np.repeat(np.arange(len(counts)), many)
        at = first[row] + (np.arange(bounds[-1]) - bounds[row])
        out = whole[at]
        for r in np.flatnonzero((counts > 0) & (counts < size)):
            k = counts[r]
            out[bounds[r]] = (hashes[first[r]: first[r] + k] * _PLACE[:k]).sum(dtype=np.uint64) + np.uint64(k) * _PLACE[60]
    return mix(out), bounds


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted and without repeats, with the new bounds."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    if not len(values):
        return values, bounds
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def shingle_sets(column: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, values, bounds): the distinct shingles of each row's text, sorted, block by block."""
    for a, b, data, offsets in blocks(column):
        if lower:
            data = LOWER[data]
        starts, _, first = words(data, offsets)
        yield a, b, *distinct_sorted(*shingles(word_hashes(data, starts), first))


def set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One signed 64-bit id for each row's set; 0 for an empty one."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ _PLACE[61]), dtype=np.uint64)])
        sums = total[bounds[1:]] - total[bounds[:-1]]
        return np.where(np.diff(bounds) > 0, mix(sums) | np.uint64(1), np.uint64(0)).view(np.int64)
