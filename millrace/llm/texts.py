"""Whole texts of an Arrow batch as one byte array: words, hashes and slices by NumPy.

Words are the runs of bytes other than space and 0x09-0x0D; UTF-8 never uses these inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function; distinct inputs stay distinct."""
    with np.errstate(over="ignore"):
        z = x.astype(U) + U(0x9E3779B97F4A7C15)
        z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
        return z ^ (z >> U(31))


BYTE_HASH = splitmix(np.arange(1, 257, dtype=U))
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}
_KEPT_POWERS = 1 << 22


def powers(base: np.uint64, n: int) -> np.ndarray:
    """Not to be written to; shorter runs are kept."""
    kept = _POWERS.get(int(base))
    if kept is not None and len(kept) >= n:
        return kept[:n]
    size = max(n, min(2 * n, _KEPT_POWERS + 1))
    with np.errstate(over="ignore"):
        out = np.full(size, base, U)
        out[:1] = 1
        out = np.cumprod(out, dtype=U)
    if size <= _KEPT_POWERS + 1:
        _POWERS[int(base)] = out
    return out[:n]


class Texts:
    """The texts of a batch end to end: ``data`` (bytes) and ``offsets`` (n + 1); a null text counts as empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
        if data is None or not len(at):
            return cls(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
        return cls(np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0])

    @classmethod
    def from_list(cls, texts: list[bytes]) -> Texts:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)]))

    def slices(self, limit: int):
        """(first, last, Texts) of consecutive texts of about ``limit`` bytes; a longer text is alone."""
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.offsets, self.offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(self))
            a, b = self.offsets[first], self.offsets[last]
            yield first, last, Texts(self.data[a:b], self.offsets[first: last + 1] - a)
            first = last

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]: self.offsets[i + 1]].tobytes()

    def with_starts(self, places: np.ndarray) -> np.ndarray:
        """The places and the starts of all texts that are not empty, ascending and distinct."""
        mark = np.zeros(len(self.data) + 1, bool)
        mark[places] = True
        mark[self.offsets[:-1]] = True
        return np.flatnonzero(mark[:-1])

    def lower(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets)

    def inner(self) -> np.ndarray:
        """Text bounds that lie inside the data."""
        return self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the index of its first word (n + 1)."""
        inside = ~SEPARATOR[self.data]
        cut = self.inner()
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[cut - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range."""
        with np.errstate(over="ignore"):
            total = np.zeros(len(self.data) + 1, U)
            np.cumsum(BYTE_HASH[self.data] * powers(BASE, len(self.data)), out=total[1:])
            back = powers(BASE_INVERSE, len(self.data) + 1)
            return splitmix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbours (len - n + 1 of them)."""
    with np.errstate(over="ignore"):
        size = max(len(hashes) - n + 1, 0)
        out = np.zeros(size, U)
        for k in range(n):
            out = splitmix(out * U(0x2545F4914F6CDD1D) + hashes[k: k + size])
        return out


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole sequence, its length included."""
    with np.errstate(over="ignore"):
        total = (splitmix(hashes) * powers(BASE, len(hashes))).sum(dtype=U) if len(hashes) else U(0)
        return splitmix(np.array([total + U(len(hashes))], U))[0]


def binary(rows: list) -> pa.Array:
    return pa.array(rows, pa.binary())
