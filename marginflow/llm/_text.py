"""Whole columns of text as numpy arrays: words, word hashes and shingles of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply), elementwise."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_P) + U64(seed * 0x632BE59BD9B4E019 & _MASK))


#: A random value per byte; A-Z count as a-z.
_BYTE = seeded(256, 1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = seeded(64, 2) | U64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = [np.cumprod(np.concatenate([[U64(1)], np.full(size, U64(p))])) for p in (_P, pow(_P, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null: empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``size`` bytes together, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes, exclusive) and row of every run of other bytes than blanks (0x20, 0x09-0x0D)."""
    base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SPACE[data[base:base + n]]
    edge = np.zeros(n + 1, bool)
    edge[offsets - base] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start) + base, np.flatnonzero(end) + base + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits per word; A-Z count as a-z. Depends on the word's bytes alone."""
    if not len(starts):
        return np.zeros(0, U64)
    base, to = int(starts[0]), int(ends[-1])
    power, inverse = _powers(to - base + 1)
    sums = np.zeros(to - base + 1, U64)
    np.cumsum(_BYTE[data[base:to]] * power[:to - base], out=sums[1:])
    s, e = starts - base, ends - base
    return mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64))


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` words running, and the bounds of each row's part.

    A row with fewer words, but one at least, gives the whole sequence as one.
    """
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    out, own = np.zeros(0, U64), np.zeros(0, np.int64)
    if n >= k:
        full = np.zeros(n - k + 1, U64)
        for j in range(k):
            full += hashes[j:n - k + 1 + j] * _PLACE[j]
        whole = rows[:n - k + 1] == rows[k - 1:]
        out, own = mix(full[whole]), rows[:n - k + 1][whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), U64)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] += hashes[first[short[has]] + j] * _PLACE[j]
        extra = mix(extra + counts[short].astype(U64) * _PLACE[-1])
        out, own = np.concatenate([out, extra]), np.concatenate([own, short])
        order = np.argsort(own, kind="stable")
        out, own = out[order], own[order]
    return out, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n_rows))])
