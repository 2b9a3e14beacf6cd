"""Hashes of many spans of a byte array at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(5).integers(0, 2 ** 64, 256, np.uint64, False)


@lru_cache(maxsize=1)
def _powers(log: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**log powers of the base, and of its inverse, modulo 2**64."""
    return tuple(
        np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 ** log - 1, b, np.uint64)]), dtype=np.uint64)
        for b in (BASE, pow(BASE, -1, 2 ** 64)))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit codes of spans of ``data``: equal for equal bytes wherever they lie.

    A code is the difference of two prefix sums of bytes' values times powers of a base, moved to the start by
    the base's inverse, and mixed with the length.
    """

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(max(20, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * powers[:len(data)], dtype=np.uint64, out=self.sums[1:])

    def codes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        span = (self.sums[stops] - self.sums[starts]) * self.inverse[starts]
        return mixed(span + (stops - starts).astype(np.uint64))
