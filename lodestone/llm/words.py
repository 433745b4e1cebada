"""Vectorised word splitting and hashing over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
_P, _M1, _M2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_PINV = pow(_P, -1, 1 << 64)
_SHINGLE = np.array([0xD6E8FEB86659FD93 | 1, 0xA0761D6478BD642F | 1, 0xE7037ED1A0B428DB | 1], dtype=U)

#: Lower-cases A-Z; 0 for bytes outside words: controls, punctuation and space of ASCII.
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    _l = _b + 32 if 65 <= _b <= 90 else _b
    _CLASS[_b] = _l if 48 <= _l <= 57 or 97 <= _l <= 122 or _l >= 128 else 0

_powers = {"p": np.ones(1, U), "i": np.ones(1, U)}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        have = np.full(max(n, 1 << 21), base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[kind] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(_M1)
    h = (h ^ (h >> U(27))) * U(_M2)
    return h ^ (h >> U(31))


def split_words(raw: np.ndarray, offsets: np.ndarray):
    """Words of texts ``raw[offsets[i]:offsets[i + 1]]``.

    Returns lower-cased bytes (0 between words), word starts and ends in them, the first word of each text
    (one more entry than texts) and a 64-bit hash of each word.  Bytes count from ``offsets[0]``.
    """
    low = _CLASS[raw[offsets[0] : offsets[-1]]]
    at = offsets - offsets[0]
    n = len(low)
    inside = low != 0
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before &= ~edge[:-1]
        after &= ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, at)
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum((low.astype(U) + U(1)) * _power("p", _P, n), out=total[1:])
    h = mix((total[ends] - total[starts]) * _power("i", _PINV, n + 1)[starts] + (ends - starts).astype(U))
    return low, starts, ends, first, h


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` (1 to 3) words, by its first word; runs that would pass the end are left out."""
    if len(h) < size:
        return np.zeros(0, U)
    n = len(h) - size + 1
    s = np.full(n, size, U)
    for k in range(size):
        s += h[k : k + n] * _SHINGLE[k]
    return mix(s)


class HashSet:
    """Sorted 64-bit hashes with a bit table in front."""

    def __init__(self, values: np.ndarray, bits: int = 20):
        self.values = np.unique(values.astype(U))
        self.shift = U(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.values >> self.shift).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and their ranks in ``values``."""
        maybe = np.flatnonzero(self.table[(h >> self.shift).astype(np.int64)])
        if not len(maybe) or not len(self.values):
            return maybe[:0], maybe[:0]
        rank = np.searchsorted(self.values, h[maybe])
        rank[rank == len(self.values)] = 0
        good = self.values[rank] == h[maybe]
        return maybe[good], rank[good]
