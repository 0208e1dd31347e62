"""A double-array trie over byte strings.

State ``s`` goes with byte ``c`` to ``t = base[s] + c + 1`` if ``check[t] == s``; ``value[t]`` is the number
of the string that ends in ``t``, or -1. Two array reads per byte, for one text or for many at once.
"""

from __future__ import annotations

import numpy as np


class DoubleArray:
    def __init__(self, strings: dict[bytes, int]) -> None:
        self.base, self.check, self.value = (x.astype(np.int32) for x in _build(strings))
        self.longest = max(map(len, strings), default=0)

    def step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, whether there is one) for arrays of states and bytes."""
        to = self.base[states] + codes + 1
        return to, self.check[to] == states


def _build(strings: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for string, number in strings.items():
        node = 0
        for c in string:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
            node = children[node][c]
        ends[node] = number
    size = 4 * len(children) + 4096
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    taken = np.zeros(size, bool)
    taken[0] = True
    free = forked = 1  # where to look for room for one child, and for several
    queue = [(0, 0)]
    while queue:
        node, state = queue.pop()
        value[state] = ends.get(node, -1)
        codes = sorted(children[node])
        if not codes:
            continue
        offsets = [c + 1 for c in codes]
        if len(codes) == 1:
            while taken[free] or free <= offsets[0]:
                free += 1
            start = free - offsets[0]
        else:
            start = forked = _room(taken, offsets, forked)
        if start + 1024 > len(base):
            more = len(base)
            base, check, value = (np.concatenate([x, np.full(more, fill, np.int64)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
            taken = np.concatenate([taken, np.zeros(more, bool)])
        base[state] = start
        for c, o in zip(codes, offsets, strict=True):
            taken[start + o] = True
            check[start + o] = state
            queue.append((children[node][c], start + o))
    # Any base plus any byte stays inside the arrays.
    used = int(np.flatnonzero(taken).max()) + 1 + 300
    cut = lambda a, fill: np.concatenate([a, np.full(300, fill, np.int64)])[:used]
    return cut(base, 0), cut(check, -1), cut(value, -1)


def _room(taken: np.ndarray, offsets: list[int], start: int) -> int:
    """The first base from ``start`` on at which all offsets are free; behind the arrays all is free."""
    while start + 512 < len(taken):
        n = min(512, len(taken) - start - 256)
        fits = np.ones(n, bool)
        for o in offsets:
            fits &= ~taken[start + o : start + o + n]
        if fits.any():
            return start + int(fits.argmax())
        start += n
    return start
