"""Words, lower case and 64-bit hashes of whole Arrow string columns, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case, and the capitals of Latin-1 in their two-byte form."""
    out = _LOWER[data]
    if len(out) > 1:
        at = np.flatnonzero(data[:-1] == 0xC3) + 1
        out[at] += (32 * ((data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97))).astype(np.uint8)
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes, or a single longer row: bounds what is in memory at once."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of the rows of one span: first and last byte, row, and hash (in lower case).

    ``between`` tells for each byte whether it is outside words; by default words are ``[^\\x20\\x09-\\x0D]+``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
        rows = len(offsets) - 1
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        solid = ~between[data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        first[inner] |= solid[inner]
        last[inner - 1] |= solid[inner - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=rows)
        self.bound = np.concatenate([[0], np.cumsum(self.count)])
        self._data, self._solid = data, solid

    def hashes(self, fold: bool = True) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) - np.repeat(ends - size, size)
        power = np.cumprod(np.full(int(size.max()), _STEP, np.uint64))
        value = self._data[self._solid]
        value = _BYTE[_LOWER[value] if fold else value] * power[place]
        return mix64(np.add.reduceat(value, ends - size) + size.astype(np.uint64))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first word and hash of every run of ``k`` words within one row."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        value = hashes[at]
        for i in range(1, k):
            value = value * _MUL + hashes[at + i]
        return at, mix64(value)
