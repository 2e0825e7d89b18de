"""Words of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than the ASCII white space. Texts are read from the Arrow
buffer in blocks of about a megabyte, so memory does not grow with the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20_260_101)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.append(np.uint64(1), np.full(63, _FACTOR)))


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-spread function of 64-bit numbers, one for each salt (splitmix64)."""
    h = h + np.uint64((salt * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.append(np.uint64(1), np.full(2 * n, _FACTOR)))
    return _powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each row begins; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def hash_block(a: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the bytes, and the first word of each row that begins at ``bounds``."""
    space = SPACE[a]
    before = np.ones(len(a), bool)
    before[1:] = space[:-1]
    before[bounds[bounds < len(a)]] = True
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    solid = np.flatnonzero(~space)
    first = np.searchsorted(solid, starts)
    lengths = np.diff(np.append(first, len(solid)))
    place = np.arange(len(solid)) - np.repeat(first, lengths)
    spread = (_LOWER if lower else _BYTE)[a[solid]] * powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(spread, first)), np.searchsorted(starts, bounds)


def blocks(offsets: np.ndarray, block: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``block`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + block, side="right")) - 1)
        yield row, min(end, rows)
        row = end


def hash_rows(a: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``hash_block``, going through one very long text in parts that end at white space."""
    if len(a) <= 4 * BLOCK:
        return hash_block(a, bounds, lower)
    found, lo = [], 0
    while lo < len(a):
        cut = min(lo + BLOCK, len(a))
        while cut < len(a) and not SPACE[a[cut]]:
            cut += 1
        found.append(hash_block(a[lo:cut], np.zeros(1, np.int64), lower)[0])
        lo = cut
    words = np.concatenate(found)
    return words, np.array([0, len(words)])


def hashed(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, word hashes, bounds``; row i has the words ``bounds[i]:bounds[i + 1]``."""
    data, offsets = text_buffer(column)
    for row, end in blocks(offsets):
        lo = offsets[row]
        yield row, end, *hash_rows(data[lo : offsets[end]], offsets[row : end + 1] - lo, lower)
