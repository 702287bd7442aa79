"""Vectorised hashes of words, shingles and windows of many texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Hashes are 64-bit, computed with NumPy over the bytes
of a whole Arrow column: a polynomial in an odd base modulo 2**64 from prefix
sums, passed through a mixing step. Two different words (or windows) of n get
equal hashes with a chance of about n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
BASE = 0x9E3779B97F4A7C15
WINDOW_BASE = 0xD6E8FEB86659FD93
_BLOCK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        one = lambda b: np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
        _powers[base] = have = (one(base), one(inverse))
    return have


def range_sums(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each range."""
    up, down = _power_table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


class Words:
    """Words of the texts of a column: ``hash``, byte ``start`` and ``end``, and
    ``first``: the index of each text's first word (one more entry than texts)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            raw = _LOWER[raw]
        inside = ~_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = np.empty(len(self.start), np.uint64)
        # blocks of whole words keep the tables of powers small
        at = 0
        while at < len(self.start):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + _BLOCK, side="right")))
            part = raw[base : self.end[to - 1]].astype(np.uint64) + np.uint64(1)
            got = range_sums(part, self.start[at:to] - base, self.end[at:to] - base, BASE)
            self.hash[at:to] = mix(got + (self.end[at:to] - self.start[at:to]).astype(np.uint64) * np.uint64(BASE))
            at = to

    def runs(self, words: int, power: int = WINDOW_BASE) -> np.ndarray:
        """Hash of the run of ``words`` words from each word (runs that leave
        their text are the caller's to skip); short by ``words - 1`` entries."""
        n = len(self.hash) - words + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        at = np.arange(n)
        out = np.empty(n, np.uint64)
        for a in range(0, n, _BLOCK):
            b = min(n, a + _BLOCK)
            out[a:b] = mix(range_sums(self.hash[a : b + words - 1], at[a:b] - a, at[a:b] - a + words, power))
        return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (short by ``width - 1``)."""
    if len(values) < width:
        return values[:0]
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
