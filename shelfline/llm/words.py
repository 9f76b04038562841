"""Word hashes of whole texts, many documents at a time.

A word is a run of bytes other than ASCII white space (``\\x20``, ``\\x09-\\x0D``).
Everything works on the UTF-8 buffer of an Arrow column with numpy; no object is
made per word. Word hashes are 64-bit: a polynomial over random byte values, mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many bytes; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers[:n]


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        grown = np.full(max(n, 2 * len(_inverse)), pow(int(_BASE), -1, 1 << 64), np.uint64)
        grown[0] = 1
        _inverse = np.cumprod(grown)
    return _inverse[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a hash, so that every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of several documents; those of document i are first[i] to first[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    data: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k words in a row, and whether all k belong to one document."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        total = self.hashes[:n].copy()
        for j in range(1, k):
            total = mix(total) + self.hashes[j : n + j]
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        return mix(total), np.arange(n) + k <= last

    def spans(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of m words in a row for any m at the same cost, and whether they stay in one document."""
        n = len(self.hashes) - m + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        sums = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * powers(len(self.hashes)), out=sums[1:])
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        return mix((sums[m:] - sums[:-m]) * inverse_powers(n)), np.arange(n) + m <= last


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[raw[0] : raw[-1]] if body is not None and raw[-1] else np.zeros(0, np.uint8)
    return data, raw - raw[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = buffers(texts)
    if lower:
        data = _LOWER[data]
    inside = ~_BLANK[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins, stops = after & ~before, before & ~after
    begins[edges] = after[edges]
    stops[edges] = before[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    if len(starts):
        body = _VALUES[data[starts[0] :]]
        body[~inside[starts[0] :]] = 0
        reach = np.diff(starts, append=len(data))
        place = np.arange(len(body)) - np.repeat(starts - starts[0], reach)
        body *= powers(int(reach.max()))[place]
        hashes = mix(np.add.reduceat(body, starts - starts[0]) + (ends - starts).astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), offsets, data)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, total = 0, 0
        for i, n in enumerate(lengths):
            if i > begin and total + n > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(n)
        yield batch.slice(begin)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
