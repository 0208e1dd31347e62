"""A minimal perfect hash over 64-bit keys, built and probed with array operations.

Keys that meet no other key in a table of ``SPARE`` bits per key are placed there by setting their
bit; the rest go on to the next, smaller table with another mixing of the key. A key's number is the
count of set bits before its own, so n keys get the numbers 0 to n - 1.
"""

from __future__ import annotations

import numpy as np

SPARE = 2
_MULTIPLIERS = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    for m in _MULTIPLIERS:
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the tables, their bits packed one after the other); keys are distinct uint64."""
    sizes, tables = [], []
    while len(keys):
        size = SPARE * len(keys) + 8
        at = (_mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        tables.append(alone)
        keys = keys[~alone[at]]
    bits = np.concatenate(tables) if tables else np.zeros(0, bool)
    return np.array(sizes, np.int64), np.packbits(bits)


class MinimalHash:
    """Probes tables made by ``build``."""

    def __init__(self, sizes: np.ndarray, packed: np.ndarray) -> None:
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.bits = np.unpackbits(packed, count=int(sizes.sum())).astype(bool)
        self.before = np.concatenate([[0], np.cumsum(self.bits)])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; -1 or any number for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes, self.starts, strict=True)):
            at = start + (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.before[at[hit]]
            open_ = open_[~hit]
        return out
