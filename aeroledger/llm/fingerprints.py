"""Vectorised names (64-bit fingerprints) of byte strings and word runs, for use inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_RNG = np.random.default_rng(20240607)
BYTE = _RNG.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    out = []
    for base in (BASE, INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Names:
    """Names of substrings of ``data``: equal strings have equal names wherever they start."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, int(len(data)).bit_length())
        up, down = powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * up[:len(data)], out=self.sums[1:])
        self.down = down

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def all(self, length: int) -> np.ndarray:
        """Names of all substrings of one length, by start."""
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
