"""The E8 lattice: nearest points, and the cells around them."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

DIMENSIONS = 8


def _even_sum(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum (the lattice D8)."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
    gap = x[odd] - point[odd]
    worst = np.abs(gap).argmax(axis=1)
    rows = np.arange(len(odd))
    point[odd, worst] += np.where(gap[rows, worst] >= 0, 1, -1)
    return point


def nearest(x: np.ndarray) -> np.ndarray:
    """The lattice point nearest to each row: of D8, or of D8 moved by one half."""
    whole, half = _even_sum(x), _even_sum(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def shortest_vectors() -> np.ndarray:
    """The 240 vectors that lead from a point to the centres of its neighbouring cells."""
    found = []
    for i, j in combinations(range(DIMENSIONS), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            vector = np.zeros(DIMENSIONS)
            vector[i], vector[j] = a, b
            found.append(vector)
    for signs in product((0.5, -0.5), repeat=DIMENSIONS):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(np.array(signs))
    return np.array(found)


_SHORTEST = shortest_vectors()


def neighbour(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The centre of the neighbouring cell that each row lies nearest to."""
    return point + _SHORTEST[((x - point) @ _SHORTEST.T).argmax(axis=1)]
