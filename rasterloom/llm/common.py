"""Shared helpers: vectorised word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def gives_back(run: Run) -> Run:
    """A task's function that ends by giving freed memory back to the system.

    Spark keeps a Python worker for later tasks, of other operators too; what a task's work arrays
    took would count against the executor for as long.
    """

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        free_memory()

    return task


def free_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def as_strings(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets, without a copy."""
    wide = pa.types.is_large_string(strings.type)
    offsets = np.frombuffer(strings.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    raw = strings.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def by_bytes(strings: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, so that work arrays stay in cache."""
    if not len(strings):
        return
    _, offsets = string_bytes(strings)
    at = 0
    while at < len(strings):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, len(strings))
        at = to


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ALPHABET = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ALPHABET[65:91] = _ALPHABET[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < size:
        size = max(size, 1 << 21)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a string array, A-Z lower-cased, as 64-bit hashes."""

    def __init__(self, strings: pa.Array, table: np.ndarray = _ALPHABET, space: np.ndarray = _SPACE):
        data, offsets = string_bytes(strings)
        n, size = len(strings), len(data)
        inside = ~space[data]
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < size]] = False
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        last = offsets[1:] - 1
        after[last[last >= 0]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        up, down = _power_table(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(table[data] * up[:size], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        self._sums, self._down = sums, down
        #: words[i] of text i are hash[first[i] : first[i + 1]]
        self.first = np.searchsorted(self.start, offsets)
        self.offsets = offsets
        self.n = n

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words are longer than ``size`` bytes, and the hashes of their first bytes."""
        longer = np.flatnonzero(self.end - self.start > size)
        at = self.start[longer]
        return longer, mix((self._sums[at + size] - self._sums[at]) * self._down[at] + np.uint64(size))


def shingle_sets(strings: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    With fewer than ``size`` words the whole sequence is the one shingle; without words the set
    is empty.
    """
    words = Words(strings)
    h = words.hash
    factor = np.uint64(0xC2B2AE3D27D4EB4F)
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        rolled = rolled * factor + h[k : k + len(rolled)]
    rolled = mix(rolled + np.uint64(size))
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            s = np.sort(rolled[a : b - size + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            one = np.zeros(1, np.uint64)
            for x in h[a:b]:
                one = one * factor + x
            yield mix(one + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
