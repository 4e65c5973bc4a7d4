"""Exact numbers for the words of a batch, from hashes checked byte by byte."""

from __future__ import annotations

import numpy as np

from .kernels import prefix_hash, span_hash


def _slices(start: np.ndarray, end: np.ndarray, limit: int):
    """Ranges of words whose spans lie within ``limit`` bytes (a longer word stands alone)."""
    i, n = 0, len(start)
    while i < n:
        j = max(i + 1, int(np.searchsorted(end, start[i] + limit, "right")))
        yield i, j
        i = j


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each word, alike wherever it lies."""
    out = np.zeros(len(start), np.uint64)
    for i, j in _slices(start, end, limit):
        out[i:j] = span_hash(prefix_hash(b[start[i]:end[j - 1]]), start[i:j] - start[i], end[i:j] - start[i])
    return out


def _bytes_agree(b: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray, limit: int = 1 << 20) -> bool:
    """Whether each word has the bytes of the word numbered in ``like``."""
    size = end - start
    if np.any(size != size[like]):
        return False
    other = np.flatnonzero(like != np.arange(len(like)))
    total = np.cumsum(size[other])
    at = 0
    while at < len(other):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        k, z = other[at:to], size[other[at:to]]
        step = np.arange(z.sum()) - np.repeat(np.cumsum(z) - z, z)
        if np.any(b[np.repeat(start[k], z) + step] != b[np.repeat(start[like[k]], z) + step]):
            return False
        at = to
    return True


def word_ids(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers from 0 of the words (equal words alike), the place of a first
    word of each number, and the hash of each number's word. Words are told
    apart by their bytes: should two hashes meet, a dictionary of the words
    themselves takes their place."""
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    h, first, ids = np.unique(word_hashes(b, start, end), return_index=True, return_inverse=True)
    if not _bytes_agree(b, start, end, first[ids]):
        seen: dict[bytes, int] = {}
        raw = b.tobytes()
        ids = np.array([seen.setdefault(raw[i:j], len(seen)) for i, j in zip(start.tolist(), end.tolist())], np.int64)
        _, first = np.unique(ids, return_index=True)
        h = word_hashes(b, start[first], end[first])
    return ids, first, h
