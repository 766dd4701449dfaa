"""Vectorised hashing of pieces of byte buffers (polynomial in an odd base modulo 2**64, then mixed)."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Powers that a worker keeps; longer buffers have theirs computed each time.
KEPT = 1 << 20
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if n <= KEPT and _powers:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for b in (BASE, _INVERSE):
        step = np.full(max(n, KEPT), b, np.uint64)
        step[0] = 1
        made.append(np.multiply.accumulate(step))
    if n <= KEPT:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of x into every bit of the result, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hashes of any slices of a buffer: equal slices have equal hashes."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sum[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sum[end] - self.sum[start]) * self.down[start]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
