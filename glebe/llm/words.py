"""Words of whole texts as numpy arrays: shared by the operators that scan text in Arrow batches.

A word is a longest run of bytes that a table marks. Texts stay UTF-8; words get a 64-bit hash of
their bytes. Scans run in pieces of about a megabyte cut between words, so a very long text costs
memory for its words only, never for per-byte work arrays of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 20
BLOCK_ROWS = 4096

_BYTES = np.arange(256)
#: words between the six ASCII white-space characters
SPACED = (_BYTES != 0x20) & ((_BYTES < 0x09) | (_BYTES > 0x0D))
#: words of digits, ASCII letters and everything beyond ASCII
ALNUM = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
#: A-Z to a-z, other bytes as they are
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_PLACE = mix(np.arange(1, 4097, dtype=U64)) | U64(1)


class Words(NamedTuple):
    row: np.ndarray  # row in the batch
    hash: np.ndarray  # of the word's bytes
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    data: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets in them; nulls count as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets


def _scan(part: np.ndarray, marked: np.ndarray, rows_at: np.ndarray):
    first = marked.copy()
    first[1:] &= ~marked[:-1]
    first[rows_at] = marked[rows_at]
    inside = np.flatnonzero(marked)
    heads = np.flatnonzero(first[inside])
    if not heads.size:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64)
    length = np.diff(np.append(heads, inside.size))
    start = inside[heads]
    place = np.arange(inside.size) - np.repeat(heads, length)
    values = (part[inside].astype(U64) + U64(1)) * _PLACE[place & 4095]
    return start, start + length, mix(np.add.reduceat(values, heads) + length.astype(U64))


def words(column: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    """All words of a string column in order."""
    data, offsets = text_bytes(column)
    lo, stop = int(offsets[0]), int(offsets[-1])
    found = []
    while lo < stop:
        size = PIECE
        while True:
            hi = min(lo + size, stop)
            part = data[lo:hi]
            marked = table[part]
            if hi == stop:
                break
            gap = np.flatnonzero(~marked[-65536:])
            if gap.size:
                hi = hi - min(65536, hi - lo) + int(gap[-1]) + 1
                part, marked = part[: hi - lo], marked[: hi - lo]
                break
            size *= 2
        a, b = np.searchsorted(offsets, (lo, hi))
        start, end, value = _scan(LOWER[part] if lower else part, marked, offsets[a:b] - lo)
        found.append((start + lo, end + lo, value))
        lo = hi
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none, np.zeros(0, U64), none, none, data)
    start, end, value = (np.concatenate(x) for x in zip(*found))
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, value, start, end, data)


def blocks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most ``BLOCK_ROWS`` rows with about ``limit`` bytes of text; a longer text stands alone."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    at, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while at < n:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, min(at + BLOCK_ROWS, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(at, to - at)
        at = to


def shingles(w: Words, rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a shorter text with a word is one shingle."""
    n = w.hash.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    counts = np.bincount(w.row, minlength=rows)
    begin = np.cumsum(counts) - counts
    keep = (begin + counts)[w.row] - np.arange(n) >= size
    keep |= (counts[w.row] < size) & (begin[w.row] == np.arange(n))
    at = np.flatnonzero(keep)
    value = np.zeros(at.size, U64)
    for k in range(size):
        inside = at + k < (begin + counts)[w.row[at]]
        word = np.where(inside, w.hash[np.minimum(at + k, n - 1)], U64(0))
        value = mix(value * U64(0x9E3779B97F4A7C15) + word + U64(k))
    return w.row[at], value


def occurrences(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value) with the number of times each occurs, sorted.

    Values keep their upper 52 bits, so that one sort of 64-bit keys serves; rows are those of a block.
    """
    key = np.sort((row.astype(U64) << U64(52)) | (value >> U64(12)))
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return (key >> U64(52)).astype(np.int64), key & U64((1 << 52) - 1), np.diff(np.append(at, row.size))
