"""Brute-force versions of operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(n, linked):
    """Component number of each of n items, by comparing all pairs."""
    of = list(range(n))
    for i in range(n):
        for j in range(i):
            if of[i] != of[j] and linked(i, j):
                old, new = max(of[i], of[j]), min(of[i], of[j])
                of = [new if x == old else x for x in of]
    return of


def similar(rows):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]

    def linked(i, j):
        if not sets[i] or not sets[j]:
            return False
        both = len(sets[i] & sets[j])
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    of = components(len(rows), linked)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for (d, _), c in zip(rows, of, strict=True) if c == of[i] and d is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def without_lines(rows):
    """Kept text (null: empty) and numbers of lines and dropped lines of rows (doc_id, text)."""
    holders = {}
    for at, (_, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(at)
    out = []
    for doc_id, t in rows:
        lines, kept = (t or "").split("\n"), []
        for x in lines:
            held = holders.get(key(x), [])
            ids = [rows[at][0] for at in held if rows[at][0] is not None]
            last = max(ids) if ids else None
            if len(held) < 3 or doc_id == last:
                kept.append(x)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
