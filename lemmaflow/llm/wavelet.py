"""Two-dimensional range reporting over a permutation by a wavelet tree, for many ranges at once."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """A tree over the values of a permutation of 0..n-1: each level parts the places of a node by one bit of their values, in order.

    A level is the array of how many places before each one have a 0 bit; zeros come before ones in the level below.
    """

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        for bit in reversed(range(max(self.n - 1, 1).bit_length())):
            zero = (values >> bit) & 1 == 0
            self.levels.append((bit, np.concatenate([[0], np.cumsum(zero)])))
            values = np.concatenate([values[zero], values[~zero]])

    def report(self, first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every value in low..high-1 at the places first..last-1, for each range: (number of the range, value)."""
        some = np.flatnonzero((first < last) & (low < high))
        of, a, b, base = some, first[some], last[some], np.zeros(len(some), np.int64)
        for bit, zeros in self.levels:
            a0, b0, nz = zeros[a], zeros[b], zeros[-1]
            of = np.concatenate([of, of])
            a, b = np.concatenate([a0, nz + a - a0]), np.concatenate([b0, nz + b - b0])
            base = np.concatenate([base, base + (1 << bit)])
            keep = (a < b) & (base < high[of]) & (base + (1 << bit) > low[of])
            of, a, b, base = of[keep], a[keep], b[keep], base[keep]
        return of, base
