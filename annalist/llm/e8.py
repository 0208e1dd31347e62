"""Decoding to the E8 lattice, with array operations.

E8 is D8 (integer points of even sum) and D8 shifted by one half. The nearest point of D8 is the
rounded point, or, where its sum is odd, the one that rounds the worst coordinate the other way.
"""

from __future__ import annotations

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    step = np.where(off[odd, worst] >= 0, 1.0, -1.0)
    r[odd, worst] += step
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest lattice points of rows of 8 numbers, doubled so that they are integers."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return (2 * np.where(nearer[:, None], half, whole)).astype(np.int64)


def _roots() -> np.ndarray:
    """The 240 shortest vectors, doubled: two entries of 2 or -2, or all of 1 or -1 with an even number of -1."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = np.zeros(8, np.int64)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        if bin(bits).count("1") % 2 == 0:
            out.append(np.array([-1 if bits >> k & 1 else 1 for k in range(8)]))
    return np.array(out)


ROOTS = _roots()


def nearest(x: np.ndarray, cells: int) -> np.ndarray:
    """For each row the nearest point and its ``cells - 1`` neighbours nearest to the row: (n, cells, 8), doubled."""
    home = decode(x)
    if cells == 1:
        return home[:, None]
    # |x - p - r|^2 grows with -(x - p) . r, as all r are equally long.
    toward = (x - home / 2) @ ROOTS.T
    best = np.argpartition(-toward, cells - 2, axis=1)[:, : cells - 1]
    order = np.take_along_axis(-toward, best, 1).argsort(1, kind="stable")
    best = np.take_along_axis(best, order, 1)
    return np.concatenate([home[:, None], home[:, None] + ROOTS[best]], axis=1)
