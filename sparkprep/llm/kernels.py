"""Vectorised numpy text kernels shared by the operators.

Texts are handled as the concatenated UTF-8 bytes of a batch plus row
offsets. Substring hashes come from prefix sums of a polynomial hash modulo
2^64 (odd base, so powers are invertible), which costs a few array passes
per byte and no per-word Python work.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_RNG = np.random.default_rng(20240607)
BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
WORD_MULT = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) | U64(1)
#: Bytes that separate words: space and \t \n \v \f \r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
PAD_WORD = U64(0xD1B54A32D192ED03)

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverse[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix (splitmix64) of an owned uint64 array."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 row offsets (from 0) of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def chunks(offsets: np.ndarray, limit: int = 4 << 20, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone) and ``rows`` rows."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield lo, hi
        lo = hi


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """C with C[i] = sum of value(b[j]) * base^j for j < i."""
    p, _ = powers(len(b) + 1)
    c = np.zeros(len(b) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUE[b] * p[:len(b)], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each byte span, independent of where it lies; the length is part of it."""
    _, inv = powers(len(c))
    with np.errstate(over="ignore"):
        return mix((c[end] - c[start]) * inv[start] + (end - start).astype(np.uint64) * U64(0xA0761D6478BD642F))


def words(b: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row offsets (into the words) of maximal runs of
    non-space bytes per row; a word also begins at each byte set in ``cut``."""
    n = len(b)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    space = IS_SPACE[b]
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    if cut is not None:
        first |= cut
    start, end = ~space, ~space
    start[1:] &= space[:-1] | first[1:]
    end[:-1] &= space[1:] | first[1:]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets)


def shingles(b: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all n-word shingles row by row, with row offsets. A row
    of 1 to n-1 words has one shingle (all its words); an empty row has none."""
    s, e, wo = words(b, offsets)
    wh = span_hash(prefix_hash(b), s, e) if len(s) else np.zeros(0, np.uint64)
    m = np.diff(wo)
    if np.any((m > 0) & (m < n)):
        length = np.where((m > 0) & (m < n), n, m)
        po = np.concatenate([[0], np.cumsum(length)])
        padded = np.full(po[-1], PAD_WORD, np.uint64)
        padded[np.repeat(po[:-1] - wo[:-1], m) + np.arange(len(wh))] = wh
        wh, wo, m = padded, po, length
    count = np.maximum(m - (n - 1), 0)
    so = np.concatenate([[0], np.cumsum(count)])
    if so[-1] == 0:
        return np.zeros(0, np.uint64), so
    with np.errstate(over="ignore"):
        total = wh[:len(wh) - n + 1] * WORD_MULT[0]
        for k in range(1, n):
            total = total + wh[k:len(wh) - n + 1 + k] * WORD_MULT[k]
    at = np.repeat(wo[:-1] - so[:-1], count) + np.arange(so[-1])
    return mix(total[at]), so


class Permutations:
    """Universal hash permutations x -> a*x + b modulo 2^32 (a odd) of the
    leading 32 bits of a mixed hash, and MinHash signatures under them."""

    def __init__(self, count: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, count, dtype=np.uint32)

    def signatures(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, count) uint32 minima; rows without shingles get the largest value."""
        rows = len(offsets) - 1
        out = np.full((rows, len(self.a)), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            x32 = (x >> U64(32)).astype(np.uint32)
            starts = offsets[full]
            with np.errstate(over="ignore"):
                for k in range(len(self.a)):
                    out[full, k] = np.minimum.reduceat(x32 * self.a[k] + self.b[k], starts)
        return out


def row_binary(matrix: np.ndarray) -> pa.Array:
    """Arrow binary column with the bytes of each row of a C-contiguous matrix."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize if matrix.ndim == 2 else matrix.itemsize
    offs = np.arange(len(matrix) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(offs), pa.py_buffer(matrix.tobytes())]).cast(pa.binary())


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow or mapInPandas, which gives freed memory back to
    the system when its task ends: workers are kept for later stages, and what
    they hold on to counts against their executor."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return whole
