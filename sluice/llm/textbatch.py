"""Words of a whole Arrow batch of texts as NumPy arrays, hashed without a loop over words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ U(seed)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=None)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U), 0x1234567)


@lru_cache(maxsize=None)
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; a worker keeps the tables, 4 MB at first."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 18, 0 if have is None else min(2 * len(have[0]), 1 << 20))
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, U)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class RunHashes:
    """Hashes of runs of ``values``, all from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int):
        power, self.inverse = _powers(base, len(values))
        self.sums = np.empty(len(values) + 1, U)
        self.sums[0] = 0
        np.cumsum(values * power, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair; ends are exclusive."""
        if not len(starts):
            return np.empty(0, U)
        inside = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(inside + (ends - starts).astype(U))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each pair, from one prefix sum; ends are exclusive."""
    return RunHashes(values, base).of(starts, ends)


class Words:
    """Words of the texts of one binary Arrow array, null as empty.

    ``start`` and ``end`` are byte places in ``data``; ``doc`` is each word's row; ``first``
    has each row's first word and one entry more.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
        data = data[offsets[0]: offsets[-1]] if n else data[:0]
        offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data, self.offsets = data, offsets
        word = ~_spaces()[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        before[edge] = False
        after[edge - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)

    def hashes(self) -> np.ndarray:
        return run_hashes(_byte_values()[self.data], self.start, self.end, _BYTE_BASE)

    def text(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """A row's words, or those that are kept, joined by one space."""
        own = range(self.first[row], self.first[row + 1])
        body = self.data[self.offsets[row]: self.offsets[row + 1]].tobytes()
        shift = self.offsets[row]
        if keep is None:
            return b" ".join(body.split())
        return b" ".join(body[self.start[i] - shift: self.end[i] - shift]
                         for i in own if keep[i - self.first[row]])


def window_hashes(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of each run of so many words that lies in one document."""
    if len(hashes) < size:
        return np.empty(0, np.int64), np.empty(0, U)
    place = np.flatnonzero(doc[: len(doc) - size + 1] == doc[size - 1:])
    return place, run_hashes(mix(hashes, 0x51ED27), place, place + size, _WORD_BASE)
