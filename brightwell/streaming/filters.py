"""Bloom filters that grow with their keys, in numpy, for the state of a stream.

A chain of filters: each is four times as large as the one before and has half its
error, and takes keys until half its bits are set. The errors of a chain add up to
less than the one asked for, however many keys come, without knowing their number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

GROWTH = 4
#: Multipliers of the 64-bit mixer (splitmix64).
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes mixed anew, differently for each ``salt``."""
    x = values + np.uint64((salt + 1) * int(_MIX[0]) % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Growing:
    """Set of 64-bit hashes. A member is always found; another with a chance below ``error``.

    ``counts`` and ``filters`` are what a chain was left with: the keys of each filter
    and its bits as bytes.
    """

    def __init__(self, error: float, first_bits: int, hashes: int = 1,
                 counts: Sequence[int] = (), filters: Sequence[bytes] = ()):
        self.error, self.first_bits, self.least = error, first_bits, hashes
        self.counts = list(counts)
        self.filters = [np.frombuffer(f, dtype=np.uint8).copy() for f in filters]

    def hashes(self, level: int) -> int:
        return max(self.least, math.ceil(math.log2(2 ** (level + 1) / self.error)))

    def capacity(self, level: int) -> int:
        """Keys that set half the bits."""
        return max(1, int(self.first_bits * GROWTH ** level * math.log(2) / self.hashes(level)))

    def _places(self, values: np.ndarray, level: int) -> np.ndarray:
        x = mixed(values, level)
        start, step = (x >> np.uint64(32))[:, None], ((x & np.uint64(0xFFFFFFFF)) | np.uint64(1))[:, None]
        i = np.arange(self.hashes(level), dtype=np.uint64)
        # The cubic term keeps two keys of equal step from sharing all their places.
        return (start + i * step + (i ** 3 - i) // np.uint64(6)) % np.uint64(len(self.filters[level]) * 8)

    def __contains__(self, value: int) -> bool:
        return bool(self.contains(np.array([value], dtype=np.uint64))[0])

    def contains(self, values: np.ndarray) -> np.ndarray:
        found = np.zeros(len(values), dtype=bool)
        for level, bits in enumerate(self.filters):
            at = self._places(values, level)
            found |= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)
        return found

    def add(self, values: np.ndarray) -> None:
        """Take distinct hashes that are not in the chain yet."""
        while len(values):
            level = len(self.filters) - 1
            if level < 0 or self.counts[level] >= self.capacity(level):
                level += 1
                self.filters.append(np.zeros(-(-self.first_bits * GROWTH ** level // 8), dtype=np.uint8))
                self.counts.append(0)
            now, values = np.split(values, [self.capacity(level) - self.counts[level]])
            at = self._places(now, level).ravel()
            np.bitwise_or.at(self.filters[level], at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            self.counts[level] += len(now)


def sift(values: np.ndarray, periods: np.ndarray, chains: dict[int, Growing], make) -> np.ndarray:
    """Which of the rows, in the order of time, have a key that is neither earlier in
    their period nor in the period before. ``chains`` (period -> keys) is brought up
    to date; ``make()`` gives a new chain."""
    fresh = np.zeros(len(values), dtype=bool)
    for period in np.unique(periods):
        here = np.flatnonzero(periods == period)
        keys, first = np.unique(values[here], return_index=True)
        chain = chains.setdefault(int(period), make())
        old = chain.contains(keys)
        before = chains.get(int(period) - 1)
        fresh[here[first]] = ~(old if before is None else old | before.contains(keys))
        chain.add(keys[~old])
    return fresh
