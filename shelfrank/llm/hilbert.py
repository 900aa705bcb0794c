"""Positions of points along a Hilbert curve of any dimension, for whole arrays at once."""

from __future__ import annotations

import numpy as np


def hilbert_positions(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of every row of ``cells`` (points x dimensions, integers of ``bits`` bits) on the curve; at most 63 bits in all.

    Works from the highest bit down: the bits of a level, as a reflected code, say which sub-cube comes when; each
    coordinate is then turned so that the curve inside that sub-cube starts and ends next to its neighbours.
    """
    points, dimensions = cells.shape
    if dimensions * bits > 63:
        raise ValueError("the position needs more than 63 bits")
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dimensions):
            upper = (x[d] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
    for d in range(1, dimensions):
        x[d] ^= x[d - 1]
    turn = np.zeros(points, dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    position = np.zeros(points, dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dimensions):
            position = position << 1 | (x[d] >> level) & 1
    return position
