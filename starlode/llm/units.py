"""Sequences of bytes or words of many texts as numpy arrays, and rolling hashes over them."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True


_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64; one table that grows."""
    if not _tables or len(_tables[0]) < n:
        size = -(-max(n, 1) // (1 << 18)) << 18
        _tables.clear()
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _tables.append(np.multiply.accumulate(table, out=table))
    return _tables[0][:n], _tables[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the low quality of a polynomial hash over all bits, in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums such that the hash of values[s:e] follows from two of them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def gram_hash(sums: np.ndarray, m: int) -> np.ndarray:
    """The hashes of all m consecutive values."""
    n = max(len(sums) - m, 0)
    return mixed((sums[m:] - sums[:n]) * powers(len(sums))[1][:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:]) if len(out) > span else out[:0]
        span *= 2
    if span < width:
        gap = width - span
        out = np.minimum(out[:-gap], out[gap:]) if len(out) > gap else out[:0]
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string array, nulls as empty, and len + 1 offsets."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system: workers outlive a stage, and the next may need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(fn: Callable) -> Callable:
    """``fn`` of a group or of two, giving memory back after each call."""

    def call(*args: object) -> pa.Table:
        try:
            return fn(*args)
        finally:
            give_back()

    if len(inspect.signature(fn).parameters) == 1:
        return lambda table: call(table)
    return lambda key, table, other: call(key, table, other)


class Units:
    """Texts cut into units: ``values`` (a hash or byte each), offsets per text, bytes per unit.

    Unit i covers ``data[begin[i]:end[i]]``, and the units i to j read as
    ``data[begin[i]:end[j]]``, which is equal for equal sequences.
    """

    def __init__(self, values, offsets, data, begin, end):
        self.values, self.offsets, self.data, self.begin, self.end = values, offsets, data, begin, end

    @classmethod
    def of_bytes(cls, texts: pa.Array) -> Units:
        data, offsets = text_bytes(texts)
        at = np.arange(len(data) + 1)
        return cls(data.astype(np.uint64) + np.uint64(1), offsets, data, at[:-1], at[1:])

    @classmethod
    def of_words(cls, texts: pa.Array) -> Units:
        """Words between ASCII whitespace; ``data`` has one blank after each."""
        data, offsets = text_bytes(texts)
        solid = ~_SPACES[data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        values = span_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1)), starts, ends)
        size = ends - starts
        begin = np.cumsum(size + 1) - (size + 1)
        packed = np.full(int(size.sum()) + len(size), 32, np.uint8)
        packed[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[solid]
        return cls(values, np.searchsorted(starts, offsets), packed, begin, begin + size)

    def __len__(self) -> int:
        return len(self.values)

    def counts(self) -> np.ndarray:
        """Units per text."""
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """The text of each unit."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())
