import math
import random

import numpy as np

from annalist.llm import e8, near_vectors
from tests.llm.plain import components

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, cosine=0.93):
    def unit(label, v):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(label, v) for _, label, v in rows]

    def linked(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b >= cosine

    n = len(rows)
    of = components(n, linked)
    links = [sum(i != j and linked(i, j) for j in range(n)) for i in range(n)]
    return sorted((rows[i][0], links[i], min(rows[j][0] for j in range(n) if of[j] == of[i])) for i in range(n))


def answer(spark, rows):
    out = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


def around(rng, centre, cosine):
    z = rng.normal(size=len(centre))
    z -= (z @ centre) * centre
    return cosine * centre + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def test_crowds_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1):
        for tight in (0.9999, 0.99, 0.97):
            centre = rng.normal(size=64)
            centre /= np.linalg.norm(centre)
            for _ in range(25):
                rows.append((n, label, around(rng, centre, tight).tolist()))
                n += 1
        rows += [(n + i, label, rng.normal(size=64).tolist()) for i in range(20)]
        n += 20
    same = rng.normal(size=64).tolist()
    rows += [(n + i, 1, same) for i in range(30)] + [(n + 30, 1, [2 * x for x in same]), (n + 31, 0, same), (n + 32, None, same)]
    n += 33
    bad = [None, [], [0.0] * 64, [*same[:63], None], [*same[:63], math.nan], [*same[:63], math.inf], same[:32]]
    rows += [(n + i, 1, v) for i, v in enumerate(bad)]
    assert answer(spark, rows) == plain(rows)


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine is just 0.93 are the hardest that count."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        rows += [(2 * i, 0, v.tolist()), (2 * i + 1, 0, around(rng, v, 0.9301).tolist())]
    found = sum(links for _, links, _ in answer(spark, rows))
    assert found >= 0.97 * sum(links for _, links, _ in plain(rows)) > 0


def test_empty_table_repeated_and_null_ids(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.01]), (3, 0, [0.0, 1.0]), (None, 0, [1.0, 0.0])]
    out = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (None, 0, None)], key=str)


def test_one_id_with_several_vectors_and_labels(spark):
    """Each row is a vector of its own, whatever others carry its id; the plain version goes by rows."""
    rng = np.random.default_rng(9)
    v, w = rng.normal(size=(2, 16))
    rows = [(5, 0, v.tolist()), (5, 1, w.tolist()), (5, 0, w.tolist()), (5, 0, [1.0, 0.0]), (7, 1, w.tolist()), (8, 0, v.tolist()), (9, 0, w.tolist())]
    rows += [(10, 1, (w + 1e-3 * v).tolist()), (4, 0, (w + 1e-3 * v).tolist()), (5, 0, (v + 0.2 * w).tolist()), (6, 2, v.tolist())]
    assert answer(spark, rows) == plain(rows)


def test_decoded_points_are_the_nearest():
    rng = random.Random(1)
    x = np.array([[rng.uniform(-2, 2) for _ in range(8)] for _ in range(300)])
    home = e8.decode(x)
    assert (np.abs(home) % 2 == np.abs(home[:, :1]) % 2).all() and (home.sum(1) % 4 == 0).all()
    distance = ((x - home / 2) ** 2).sum(1)
    for root in e8.ROOTS:
        assert (distance <= ((x - (home + root) / 2) ** 2).sum(1) + 1e-9).all()
    assert len(np.unique(e8.ROOTS, axis=0)) == 240 and (distance <= 1 + 1e-9).all()


def test_links_just_at_the_threshold(spark):
    """Two vectors nearly equal and a third just within the threshold of one and just beyond it of the other."""
    c = 0.93
    a = np.zeros(16)
    a[0] = 1.0
    third = np.zeros(16)
    third[0], third[1] = c + 1.5e-9, math.sqrt(1 - (c + 1.5e-9) ** 2)
    b = np.zeros(16)
    b[0], b[1] = math.cos(1.2e-8), -math.sin(1.2e-8)
    rows = [(1, 0, a.tolist()), (2, 0, b.tolist()), (3, 0, third.tolist())]
    out = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert (a @ third >= c) and not b @ third >= c
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 2, 1), (2, 1, 1), (3, 1, 1)]


def test_many_triples_around_the_threshold(spark):
    """Vectors in tiny crowds on both sides of the threshold, each triple with a label of its own."""
    rng, rows = np.random.default_rng(12), []
    for i in range(400):
        v = rng.normal(size=16)
        v /= np.linalg.norm(v)
        w = around(rng, v, 0.93 + 10.0 ** -rng.integers(2, 13) * rng.choice([-1, 1]))
        for k, x in enumerate((v, w, v + 10.0 ** -rng.integers(6, 12) * rng.normal(size=16))):
            rows.append((3 * i + k, i, x.tolist()))
    expected, wrong = [], 0
    for i in range(400):
        units = [np.array(r[2]) / np.linalg.norm(r[2]) for r in rows[3 * i : 3 * i + 3]]
        expected += [sum(j != k and units[j] @ units[k] >= 0.93 for k in range(3)) for j in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(frame, tables=16).collect()}
    wrong = sum(got[i] > expected[i] for i in range(1200))
    assert wrong == 0 and sum(got.values()) >= 0.97 * sum(expected)


def test_crowds_on_both_sides_write_no_pairs(spark, monkeypatch):
    """Counts are those of all pairs, members are compared in blocks, and rows grow with the crowd."""
    rng = np.random.default_rng(13)
    v = rng.normal(size=32)
    v /= np.linalg.norm(v)
    w = around(rng, v, 0.93)
    written, rows_of = [], near_vectors.materialize

    def counted(df, label):
        out = rows_of(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(near_vectors, "materialize", counted)
    monkeypatch.setattr(near_vectors, "CHUNK", 64)
    most = {}
    for size in (150, 300):
        rows = [(i, 0, around(rng, (v, w)[i % 2], 1 - 1e-7 * rng.random()).tolist()) for i in range(size)]
        written.clear()
        assert answer(spark, rows) == plain(rows)
        most[size] = dict(written)
    assert 0 < most[300]["vector-judged"] <= 3 * most[150]["vector-judged"] and most[300]["vector-links"] < 2_000
