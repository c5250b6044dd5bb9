"""Vectorised words, word hashes and windows over Arrow text columns.

A word is a maximal run of bytes of a class that never splits a UTF-8 character.
Its hash is a polynomial over random byte values modulo 2**64, taken from prefix
sums, so that no Python object is made for a word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes of text that one vectorised step handles.
STEP = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def randoms(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed * 2 + 1))


def _table() -> np.ndarray:
    table = randoms(7, 256)
    table[65:91] = table[97:123]
    return table


#: Random value of each byte; A-Z as a-z.
BYTE = _table()
#: The same with every byte of its own.
CASED = randoms(7, 256)

#: Bytes that separate words: white space, or everything in ASCII but letters and digits.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = MARKS[128:] = False


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, out=p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n or more."""
    size = STEP // 2
    while size < n:
        size *= 2
    return _powers(size)


def prefix(raw: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Prefix sums whose differences, scaled, are hashes of substrings; one longer than raw."""
    up, _ = powers(len(raw) + 1)
    out = np.empty(len(raw) + 1, np.uint64)
    out[0] = 0
    np.cumsum(table[raw] * up[: len(raw)], out=out[1:])
    return out


class Words:
    """Words of the rows of one block: starts, ends and, for each row, the range of its words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
        apart = separators[raw]
        n = len(raw)
        self.raw, self.offsets, self._sums = raw, offsets, None
        if not n:
            self.starts = self.ends = np.zeros(0, np.int64)
        else:
            before = np.empty(n, bool)
            before[0] = True
            before[1:] = apart[:-1]
            before[offsets[:-1][offsets[:-1] < n]] = True
            after = np.empty(n, bool)
            after[-1] = True
            after[:-1] = apart[1:]
            ends = offsets[1:][offsets[1:] > 0] - 1
            after[ends] = True
            inside = ~apart
            self.starts = np.flatnonzero(inside & before)
            self.ends = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, most: int = 0) -> np.ndarray:
        """Hash of each word, or of its first bytes if `most` is given."""
        if self._sums is None:
            self._sums = prefix(self.raw)
        _, down = powers(len(self.raw) + 1)
        ends = np.minimum(self.ends, self.starts + most) if most else self.ends
        return mix((self._sums[ends] - self._sums[self.starts]) * down[self.starts])

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_STEPS = randoms(11, 64) | np.uint64(1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words, rows ignored; len(hashes) - size + 1 values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * _STEPS[0]
    for k in range(1, size):
        out = out + hashes[k : n + k] * _STEPS[k]
    return mix(out)


def row_windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes within rows, and their rows; a row of fewer words, but not none, gives one for all of them."""
    whole = windows(hashes, size)
    rows = words.rows()
    inside = rows[: len(whole)] == rows[size - 1 :] if len(whole) else np.zeros(0, bool)
    out, at = whole[inside], rows[: len(whole)][inside]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        extra = [windows(hashes[words.first[r] : words.first[r + 1]], int(words.counts[r]))[0] for r in short]
        out, at = np.concatenate([out, np.array(extra, np.uint64)]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at
