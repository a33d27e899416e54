"""Vectorised word and hash primitives over Arrow text batches.

All functions work on the raw UTF-8 bytes of a bounded slice of a batch, so that
memory stays flat whatever the batch holds; one document longer than the bound
forms a slice of its own and is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


_BASE = 0xD6E8FEB86659FD93
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        out = []
        for base in (_BASE, _inverse(_BASE)):
            a = np.full(n, base, U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        if n > 4 * SLICE_BYTES:
            return out[0], out[1]  # an outsized document must not pin its tables in the worker
        _powers = (out[0], out[1])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= _MULT
    x ^= x >> U64(29)
    return x


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask that is true inside the inclusive byte ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: The bytes that separate words: white space, or all ASCII but letters and digits.
SPACE = table((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
AS_IS = np.arange(256, dtype=np.uint8)
_TABLE = mix(np.arange(1, 257, dtype=U64) * _MULT)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows, from 0; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, o - o[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives what this worker has freed back to the machine: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) pieces of at most about `limit` text bytes; whole rows only. Freed memory goes back after each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
        del batch, data, offsets
        release()


class Words:
    """Words of a slice: byte spans, 64-bit hashes and the range of words of each row."""

    __slots__ = ("start", "end", "hash", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, fold: np.ndarray = LOWER):
        n = len(data)
        inside = np.zeros(n + 1, bool)
        np.logical_not(separators[data], out=inside[:n])
        begins = np.zeros(n + 1, bool)
        begins[offsets[:-1]] = True
        prev = np.zeros(n + 1, bool)
        prev[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (begins | ~prev))
        if n:
            cut = begins | ~inside
            self.end = np.flatnonzero(prev & cut)
            if prev[n] and not cut[n]:  # cannot be: inside[n] is false
                raise AssertionError
        else:
            self.end = self.start
        self.first = np.searchsorted(self.start, offsets)
        pw, inv = powers(n + 1)
        terms = np.zeros(n + 1, U64)
        np.multiply(_TABLE[fold[data]], pw[:n], out=terms[1:])
        np.cumsum(terms, out=terms)
        h = terms[self.end] - terms[self.start]
        h *= inv[self.start]
        self.hash = mix(h)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first) of each run of `width` words of a row; a shorter row that isn't empty is one run."""
    n = len(words.hash)
    counts = words.counts
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(many)])
    if not n:
        return np.zeros(0, U64), first
    rolled = np.zeros(n, U64)
    if n >= width:
        acc = words.hash[: n - width + 1] + U64(width)
        for k in range(1, width):
            acc *= U64(_BASE)
            acc += words.hash[k : n - width + 1 + k]
        rolled[: n - width + 1] = mix(acc)
    for row in np.flatnonzero((counts > 0) & (counts < width)):
        acc = int(words.hash[words.first[row]]) + int(counts[row])
        for k in range(1, int(counts[row])):
            acc = acc * _BASE + int(words.hash[words.first[row] + k])
        rolled[words.first[row]] = mix(np.array([acc & (1 << 64) - 1], U64))[0]
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], many)
    return rolled[at], first


def binary16(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """One 16-byte binary value a row from two arrays of 64-bit numbers."""
    n = len(a)
    both = np.empty((n, 2), U64)
    both[:, 0], both[:, 1] = a, b
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, 16 * n + 1, 16, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(both))])


def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))
