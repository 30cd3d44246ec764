"""Vectorised words and hashes of Arrow text columns, a few megabytes at a time whatever the batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together, unless one text is longer.
PIECE = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13 | 3
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``size`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words with A-Z lower-cased, and where each text's words begin among them (one more than texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin[edges] |= word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[edges - 1] |= word[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[_LOWER[data]] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h), np.searchsorted(starts, offsets).astype(np.int64)


def release() -> None:
    """Give freed memory back to the system, where the C library can; for the end of a task, as Spark's workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shingles(words: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``width`` words, sorted; all words as one shingle if there are fewer, nothing without words."""
    h = words.copy()
    for k in range(1, width):
        if len(h) > k:
            h[: len(h) - k] = mix(h[: len(h) - k] * np.uint64(0xC2B2AE3D27D4EB4F) + words[k:])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(h[a : b - width + 1]))
        elif b > a:
            one = words[a : a + 1].copy()
            for k in range(a + 1, b):
                one = mix(one * np.uint64(0xC2B2AE3D27D4EB4F) + words[k : k + 1])
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
