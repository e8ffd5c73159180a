"""Vectorised 64-bit hashes of stretches of a code point array."""

from __future__ import annotations

import numpy as np

from orrery.llm.common import mix

_U = np.uint64
BASE = 0x9E3779B97F4A7C15
GOLD = _U(BASE)
_INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse (modulo 2^64), grown on
    demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            factors = np.ones(max(n, 1 << 16), dtype=np.uint64)
            factors[1:] = GOLD
            self.up = np.multiply.accumulate(factors)
            factors[1:] = _U(_INVERSE)
            self.down = np.multiply.accumulate(factors)
        return self.up, self.down


def stretch_hashes(points: np.ndarray, begin: np.ndarray, end: np.ndarray,
                   powers: Powers) -> np.ndarray:
    """Hashes of points[begin:end], the same wherever a stretch stands."""
    up, down = powers.upto(len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + _U(1)) * up[:len(points)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * GOLD)


def words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of all runs outside white space and zeros. The last
    point is a zero."""
    blank = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]
