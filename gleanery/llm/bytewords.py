"""Words of a text as arrays: boundaries and 64-bit hashes of all words at once, without a Python object a word.

A word is a run of bytes other than ASCII white space in UTF-8.  Its hash is a polynomial in a random value a byte,
modulo 2^64, from one running sum over the text.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_VALUE = np.random.default_rng(1905).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


CHUNK = 1 << 20  # bytes of a text that are hashed at once


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        m = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for i, base in enumerate((_P, _INV)):
                x = np.full(m, base, np.uint64)
                x[0] = 1
                _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers


def bounds(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    word = np.zeros(len(b) + 2, np.int8)
    word[1:-1] = ~SPACE[b]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of every span of a byte array; spans in ascending order.  A hash doesn't depend on the place, so a long text is taken in
    runs of spans of about ``CHUNK`` bytes, and what is kept between calls is bounded by that or the longest span."""
    if len(b) <= CHUNK:
        return _hashes(b, starts, ends)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, "right")))
        out[at:to] = _hashes(b[lo : int(ends[to - 1])], starts[at:to] - lo, ends[at:to] - lo)
        at = to
    return out


def _hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    p, q = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * p[: len(b)], out=total[1:])
    h = (total[ends] - total[starts]) * q[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h
