"""Texts as Arrow buffers: blocks of whole texts, rolling hashes, words.

A batch's text column is one UTF-8 buffer with offsets, so hashes and word
limits of many texts are computed at once without building Python strings.
All separators used here are ASCII, which never occurs inside a longer UTF-8
sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
GAMMA = U64(0x9E3779B97F4A7C15)
BASE = U64(0xD6E8FEB86659FD93)
MULTIPLIER = U64(0xC2B2AE3D27D4EB4F)
BLOCK_BYTES = 1 << 20


def salted(n: int) -> np.uint64:
    """The n-th of a series of odd-looking constants."""
    return U64(n * int(GAMMA) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _inverse(odd: np.uint64) -> np.uint64:
    value, modulus = int(odd), 1 << 64
    return U64(pow(value, -1, modulus))


TABLE = mix(np.arange(1, 257, dtype=U64) * GAMMA)
INVERSE = _inverse(BASE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; the largest tables up to a block's need are kept."""
    if _powers and len(_powers[0]) >= n:
        return _powers
    tables = []
    for factor in (BASE, INVERSE):
        power = np.full(1 << max(12, int(n - 1).bit_length()), factor, dtype=U64)
        power[0] = U64(1)
        tables.append(np.multiply.accumulate(power))
    if n <= 2 * BLOCK_BYTES:
        _powers[:] = tables
    return tables


class Rolling:
    """Hashes of any span of a byte buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(TABLE[data] * up[: len(data)], out=self.prefix[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hashes of ``data[start:end]``; equal bytes give equal hashes wherever they stand."""
        return (self.prefix[end] - self.prefix[start]) * self.down[start]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` for runs of whole texts of about ``most`` bytes."""
    data, at = utf8(column)
    row = 0
    while row < len(at) - 1:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        stop = min(stop, len(at) - 1)
        yield row, stop, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``; words never cross texts."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return mix(Rolling(data).spans(start, end) + (end - start).astype(U64) * MULTIPLIER)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive words, wherever they lie."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for i in range(width):
        total = total * MULTIPLIER + hashes[i : i + n]
    return mix(total + U64(width))
