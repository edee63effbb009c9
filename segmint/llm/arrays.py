"""Text as numpy arrays: words, 64-bit word and shingle hashes of whole Arrow string columns.

Used inside Spark tasks.  Everything works on the UTF-8 bytes of a batch at once; a batch is cut into
blocks of whole texts so that memory stays bounded (a single longer text is one block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SHINGLE = 5

_rng = np.random.default_rng(20250101)
#: White space of the word rule: the blank and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256)
LOWER[65:91] += 32
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTE[LOWER]
_BASE = np.uint64(int(_rng.integers(1, 1 << 62)) | 5)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, row offsets into them) of consecutive texts of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end - at, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over random byte values, finalised with the length."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[data] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_ROUND = _rng.integers(1, 1 << 63, 3, dtype=np.uint64) | np.uint64(1)
_FOLD = LOWER.astype(np.uint8)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, mixed in eight bytes at a time: each step is one-to-one in its eight
    bytes, so spans that differ in one step only never collide, and no pattern of bytes does so by itself."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    text = np.concatenate([_FOLD[data] if fold else data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", text.data, strides=(1,))  # the eight bytes from each place on
    left, at, who = (ends - starts).astype(np.int64), starts.astype(np.int64), np.arange(len(starts))
    out = mix(left.astype(np.uint64) * _ROUND[0])
    while len(who):
        bits = (8 * np.minimum(left, 8)).astype(np.uint64)
        own = np.where(left < 8, eight[at] & ((np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1)), eight[at])
        out[who] = mix((out[who] ^ own) * _ROUND[1] + _ROUND[2])
        on = left > 8
        who, at, left = who[on], at[on] + 8, left[on] - 8
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per row) of the words ``[^\\x20\\x09-\\x0D]+`` of each row."""
    n = len(data)
    rows = len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    gap = SPACE[data]
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    per_row = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, per_row


def shingles(hashes: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, index of first word, shingles per row) of all five-word shingles, in text order.

    A row of fewer words has its whole sequence as one shingle; a row without words has none.
    """
    first = np.concatenate([[0], np.cumsum(per_row)])[:-1].astype(np.int64)
    count = np.where(per_row >= SHINGLE, per_row - SHINGLE + 1, (per_row > 0).astype(np.int64))
    at = np.repeat(first, count) + ragged_arange(count)
    if not len(at):
        return np.zeros(0, np.uint64), at, count
    short = np.repeat(per_row, count) < SHINGLE
    have = np.repeat(np.minimum(per_row, SHINGLE), count)
    out = np.zeros(len(at), np.uint64)
    last = len(hashes) - 1
    for j in range(SHINGLE):
        out += np.where(j < have, hashes[np.minimum(at + j, last)], np.uint64(0)) * _STEP[j] if short.any() \
            else hashes[at + j] * _STEP[j]
    return mix(out + have.astype(np.uint64)), at, count


def ragged_arange(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c of ``counts``, one after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a string column."""
    for at, rows, data, offsets in blocks(column):
        starts, ends, per_row = words(data, offsets)
        h, _, count = shingles(word_hashes(data, starts, ends), per_row)
        bounds = np.concatenate([[0], np.cumsum(count)])
        for r in range(rows):
            yield at + r, np.unique(h[bounds[r]:bounds[r + 1]])
