"""Words and n-gram hashes of Arrow text batches, in NumPy, without a loop over words.

A word is a maximal run of bytes other than space and tab to carriage return.
Its 64-bit hash is a polynomial over its bytes (differences of one running sum
per batch), so whole texts of any length cost a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    """hash, start and end byte of every word; words of text i are ``first[i]:first[i + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[offsets[0]:offsets[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = utf8(texts)
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64), data)
    inside = ~_WHITE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = np.unique(offsets[1:-1])
    edge = edge[(edge > 0) & (edge < n)]
    begins[edge] |= inside[edge]
    stops[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up, out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return Words(hashes, start, end, np.searchsorted(start, offsets), data)


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words of the array (no regard to text borders)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc *= _STEP
        acc += word_hashes[j:j + n]
    return mix(acc)


def slices(batch: pa.RecordBatch | pa.Table, text_col: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most ``limit`` text bytes each (a longer single text stands alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(text_col))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop
