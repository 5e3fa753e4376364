"""Words of whole texts as 64-bit hashes, computed on Arrow's text buffers without Python strings.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 never uses those bytes inside a
character. A word's hash is a polynomial over random byte values, taken from one running sum per chunk.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def process_tables() -> dict:
    """Tables a process has built for itself; workers keep theirs from task to task."""
    return sys.__dict__.setdefault("_tidemark_tables", {})


def give_back() -> None:
    """Return to the system what Arrow and the C library keep for later: a worker lives on beside its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def frugal(step: Callable) -> Callable:
    """A step of a task, over its batches or over a group, after which free memory is given back."""

    @functools.wraps(step)
    def over_batches(*args, **kwargs):
        try:
            yield from step(*args, **kwargs)
        finally:
            give_back()

    @functools.wraps(step)
    def over_group(rows, *args):  # Spark counts the named arguments
        try:
            return step(rows, *args)
        finally:
            give_back()

    return over_batches if inspect.isgeneratorfunction(step) else over_group


def _powers(base: np.uint64, size: int) -> np.ndarray:
    tables = process_tables()
    if base not in tables or len(tables[base]) < size:
        made = np.full(max(size, CHUNK_BYTES + 1), base, dtype=np.uint64)
        made[0] = 1
        tables[base] = np.multiply.accumulate(made)
    return tables[base][:size]


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of consecutive documents: ``hashes``, byte ``start``/``stop``, first word per document."""

    data: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    size = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before, after = np.ones(size + 1, bool), np.ones(size + 1, bool)
    before[1:], after[: max(size - 1, 0)] = space, space[1:]
    before[offsets[:-1]] = True
    after[offsets[1:] - 1] = True  # an empty first document marks the spare last place
    start = np.flatnonzero(before[:size] & ~space)
    stop = np.flatnonzero(after[:size] & ~space) + 1
    sums = np.empty(size + 1, np.uint64)  # one array for all steps: fresh memory costs more than the arithmetic
    sums[0] = 0
    np.take(_byte_values(lower), data, out=sums[1:], mode="clip")
    sums[1:] *= _powers(_BASE, size)
    np.cumsum(sums, out=sums)
    hashes = mix((sums[stop] - sums[start]) * _powers(_INVERSE, size + 1)[start])
    return Words(data, hashes, start, stop, np.searchsorted(start, offsets))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole documents in runs of about ``size`` bytes: first, past-last, bytes, offsets. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words; runs may cross documents."""
    count = max(len(hashes) - size + 1, 0)
    out = hashes[:count].copy()
    for k in range(1, size):
        out = out * _BASE + hashes[k : k + count]
    return mix(out)


def spans(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each word sequence hashes[start:stop]."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes) * _powers(_BASE, len(hashes)), out=sums[1:])
    return mix((sums[stop] - sums[start]) * _powers(_INVERSE, len(hashes) + 1)[start])
