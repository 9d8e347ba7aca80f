"""Whole texts as flat arrays: bytes, words and hashes of an Arrow batch at once.

Texts of a batch are laid end to end and handled by array operations, a few
megabytes at a time, so that temporary arrays stay small whatever the length of
a batch. Nothing crosses the end of a text. NULL counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


@dataclass
class Chunk:
    """Consecutive texts of a batch: row of the first, their bytes, where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into runs of whole texts of about `limit` bytes, at least one text each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        start = offsets[first]
        yield Chunk(first, data[start : offsets[last]], offsets[first : last + 1] - start)
        first = last


def mix(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    value = value ^ (value >> np.uint64(30))
    value = value * _MIX_1
    value ^= value >> np.uint64(27)
    value *= _MIX_2
    value ^= value >> np.uint64(31)
    return value


_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _powers, _inverse
    if len(_powers) < size:
        size = max(size, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = inverse
        _inverse = np.multiply.accumulate(steps)
    return _powers, _inverse


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z made lower case."""
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + (upper.astype(np.uint8) << 5)


@dataclass
class Words:
    """Words of a chunk: byte ranges, hashes, and per text the number of its first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs without white space (space, tab, line feed to carriage return)."""
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64))
    solid = ~_SPACE[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(starts, ends, range_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges by one running polynomial."""
    powers, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1 + seed)) * powers[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def gram_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` consecutive values, by doubling."""
    if len(values) < length:
        return np.zeros(0, dtype=np.uint64)
    known, result, done = values.astype(np.uint64), None, 0
    size = 1
    while True:
        if length & size:
            if result is None:
                result, done = known, size
            else:
                n = len(values) - done - size + 1
                result = mix(result[:n] * _BASE + known[done : done + n])
                done += size
        if size * 2 > length:
            return result
        known = mix(known[:-size] * _BASE + known[size:])
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: len(values) - (width - size)], values[width - size :])
    return values


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def cover(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places lie in any of the ranges."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed numbers, which is what Spark stores."""
    return values.view(np.int64)
