"""Vectorised hashes of byte windows and of words, alike on every machine.

A window is hashed by two polynomials modulo the prime 2^31 - 1, whose bases and byte values
are independent. (Modulo a power of two, polynomials of some regular strings, such as those
of Thue and Morse, are equal whatever the base is.)
"""

from __future__ import annotations

import functools

import numpy as np

_BITS = np.uint64(31)
_PRIME = (1 << 31) - 1
_LOW = np.uint64(_PRIME)
_SEED = 20240301


@functools.cache
def _random() -> tuple[np.ndarray, tuple[int, int]]:
    """The values of the bytes in either polynomial, and the bases."""
    rng = np.random.default_rng(_SEED)
    values = rng.integers(1, _PRIME, (2, 256), dtype=np.uint64)
    return values, tuple(int(b) for b in rng.integers(1 << 20, _PRIME, 2))


def _folded(x: np.ndarray) -> np.ndarray:
    """Something smaller, and below 2^34, with the same residue."""
    return (x & _LOW) + (x >> _BITS)


def _residue(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    return np.where(x >= _LOW, x - _LOW, x)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the bases and of their inverses, for positions below ``n`` (a power of two)."""
    tables = []
    for bases in (_random()[1], [pow(b, -1, _PRIME) for b in _random()[1]]):
        table = np.ones((2, n), np.uint64)
        for row, base in zip(table, bases):
            size = 1
            while size < n:
                row[size:2 * size] = _residue(row[:size] * np.uint64(pow(base, size, _PRIME)))
                size *= 2
        tables.append(table)
    return tables[0], tables[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of any windows of a byte array: equal bytes, equal hash."""

    def __init__(self, data: np.ndarray):
        room = 1 << max(16, int(len(data)).bit_length())
        up, self._down = _powers(room)
        self._sums = np.zeros((2, len(data) + 1), np.uint64)
        for sums, values, powers in zip(self._sums, _random()[0], up):
            np.cumsum(_folded(values[data] * powers[:len(data)]), out=sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._hashes(
            [sums[ends] - sums[starts] for sums in self._sums], [down[starts] for down in self._down]
        )

    def windows(self, size: int) -> np.ndarray:
        """The hash of each window of ``size`` bytes, by its start."""
        n = self._sums.shape[1] - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return self._hashes([sums[size:] - sums[:n] for sums in self._sums], self._down[:, :n])

    @staticmethod
    def _hashes(sums: list[np.ndarray], down) -> np.ndarray:
        first, second = (_residue(_residue(s) * d) for s, d in zip(sums, down))
        return mixed(first << np.uint64(32) | second)
