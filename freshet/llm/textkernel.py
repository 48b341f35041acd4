"""Vectorised word, shingle and hash kernel over Arrow string columns.

Works on the UTF-8 bytes of a whole slice of texts at once; a word is ``[^\\x20\\x09-\\x0D]+`` and only A-Z are
lower-cased, so both are exact on bytes. Words are known by 64-bit hashes: at 10^9 distinct words about 0.03 pairs of
them are expected to share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 2 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE_CODE_LOWER = _BYTE_CODE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_BASE = [pow(0xD1342543DE82EF95, j, 1 << 64) for j in range(16)]
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

END = 0x5EEDED0000000001
START = 0x5EEDED0000000003


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step, dtype=np.uint64)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (one row at least), with their bytes and offsets: bounds what the kernel
    holds at once however long the texts are."""
    data, offsets = text_bytes(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of the bytes of each span: a polynomial by differences of running sums, then mixed."""
    power, inverse = _powers_to(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTE_CODE_LOWER if lower else _BYTE_CODE)[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def rows_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each of the ascending ``places``."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(places, offsets)))


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Every word of every row, in order, with its hash."""
    n = len(offsets) - 1
    none = np.zeros(0, dtype=np.int64)
    if not len(data):
        return Words(none, none, none, np.zeros(n, dtype=np.int64), none.astype(np.uint64))
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = rows_of(starts, offsets)
    return Words(starts, ends, row, np.bincount(row, minlength=n), span_hashes(data, starts, ends, lower))


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every ``size``-word shingle; a row of fewer words has its whole sequence as its only one."""
    n = len(w.hashes)
    long_rows = w.counts >= size
    first = np.concatenate(([0], np.cumsum(w.counts)[:-1])) if len(w.counts) else np.zeros(0, dtype=np.int64)
    width = max(0, n - size + 1)
    acc = np.full(width, size * 0x632BE59BD9B4E019 % (1 << 64), dtype=np.uint64)
    for j in range(size):
        acc += w.hashes[j : j + width] * U64(_WORD_BASE[j])
    keep = np.zeros(width, dtype=bool)
    if width:
        keep = (w.row[:width] == w.row[size - 1 : size - 1 + width]) & long_rows[w.row[:width]]
    rows, out = [w.row[:width][keep]], [mix(acc[keep])]
    for c in range(1, size):
        at = np.flatnonzero(w.counts == c)
        if len(at):
            acc = np.full(len(at), c * 0x632BE59BD9B4E019 % (1 << 64), dtype=np.uint64)
            for j in range(c):
                acc += w.hashes[first[at] + j] * U64(_WORD_BASE[j])
            rows.append(at)
            out.append(mix(acc))
    return np.concatenate(rows), np.concatenate(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles."""
    row, sh = shingles(words(data, offsets), size)
    order = np.argsort(row, kind="stable")
    sh = sh[order]
    ends = np.cumsum(np.bincount(row, minlength=len(offsets) - 1))
    return [np.unique(part) for part in np.split(sh, ends[:-1])] if len(ends) else []
