import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=vc.PARTS, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """(vec_id, code, error, label_error, sha256) by the definition, all distances in integers."""
    kept = [(i, x, label) for i, x, label in rows if x and all(e is not None and np.isfinite(e) for e in x)]
    if not kept:
        return []
    points = np.array([[int(np.floor(1024 * e)) for e in x] for _, x, _ in kept], object)
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, points[j].astype(np.int32).tobytes()))[:entries]
    cut = np.split(points, parts, axis=1)
    books = [c[first].copy() for c in cut]

    def nearest(c, book):
        d = np.array([[sum((a - b) ** 2 for a, b in zip(x, e)) for e in book] for x in c], object)
        code = [min(range(len(book)), key=lambda k: (row[k], k)) for row in d]
        return code, [row[k] for row, k in zip(d, code)]

    for _ in range(rounds):
        for c, book in zip(cut, books):
            code = np.array(nearest(c, book)[0])
            for k in range(len(book)):
                if (code == k).any():
                    book[k] = [sum(col) // len(col) for col in c[code == k].T.tolist()]
    done = [nearest(c, book) for c, book in zip(cut, books)]
    flat = ",".join(str(x) for book in books for e in book.tolist() for x in e)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    errors = [sum(d[j] for _, d in done) for j in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{code[j]:02x}" for code, _ in done), errors[j], by_label[label], sha) for j, (i, _, label) in enumerate(kept)), key=str
    )


def coded(spark, rows, **how):
    codes, books = vc.compressed(spark.createDataFrame(rows, SCHEMA).repartition(4), **how)
    flat = ",".join(str(x) for book in books for e in book.tolist() for x in e)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    return sorted(((r["vec_id"], r["codes"].hex(), r["error"], r["label_error"], sha) for r in vc.with_label_errors(codes).collect()), key=str)


@pytest.mark.parametrize("spread", [1.0, 0.02, 200.0])
def test_equal_to_plain_rounds(spark, spread):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(9, 8))
    rows = [(int(i), (spread * (centres[rng.integers(9)] + 0.3 * rng.normal(size=8))).tolist(), int(rng.integers(3))) for i in rng.permutation(300)]
    assert coded(spark, rows, entries=24, rounds=5) == plain(rows, entries=24, rounds=5)


def test_awkward_vectors(spark):
    x = [0.5, -0.25, 1.0, 2.0]
    rows = [
        (1, x, 1), (2, None, 1), (3, [0.1, None, 0.2, 0.3], 1), (4, [float("nan"), 0.0, 0.0, 0.0], None), (5, [float("inf"), 0.0, 0.0, 0.0], 2),
        (6, [], 1), (7, [0.0] * 4, None), (7, x, None), (7, x, None), (None, [9.0, 9.0, 9.0, 9.0], 3), (8, x, 3), (9, [-x for x in x], 2),
    ]
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, rows, entries=3) == plain(rows, entries=3)
    assert coded(spark, []) == [] and coded(spark, [(1, None, None)]) == []
    with pytest.raises(Exception, match="cannot be cut"):
        coded(spark, [(1, [1.0, 2.0, 3.0], 1)])
    with pytest.raises(Exception, match="beyond"):
        coded(spark, [(1, [1e30] * 4, 1)])


def test_all_vectors_equal(spark):
    rows = [(i, [0.1, 0.2, 0.3, 0.4], i % 2) for i in range(700)]
    assert coded(spark, rows) == plain(rows)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_bounds_never_decide(data):
    """Codes equal those of all distances while entries move at random, whatever the lists' lengths."""
    seed, k, n, width = data.draw(st.tuples(st.integers(0, 10**6), st.integers(1, 20), st.integers(1, 60), st.integers(1, 4)))
    big = data.draw(st.sampled_from([3, 50, 10**6, 1 << 25]))
    rng = np.random.default_rng(seed)
    points, book = rng.integers(-big, big, (n, width)), rng.integers(-big, big, (k, width))
    state = vc.Bounds.fresh(points, book, data.draw(st.integers(1, 6)))
    for _ in range(5):
        new = book + rng.integers(-max(1, big // 20), max(2, big // 20), book.shape) * (rng.random((k, 1)) < 0.7)
        moves = np.nextafter(vc._over(((new - book) ** 2).sum(1)).astype(np.float64), np.inf)
        state, depth = vc.reassigned(points, new, state.moved(moves), data.draw(st.integers(1, 6)))
        d = ((points[:, None, :] - new[None]) ** 2).sum(2)
        assert state.code.tolist() == d.argmin(1).tolist()
        assert (state.upper.astype(np.float64) ** 2 >= d[np.arange(n), state.code] * (1 - 1e-9)).all()
        book = new


def test_depth_saves_comparisons():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (32, 8))
    points = centres[rng.integers(32, size=2000)] + rng.integers(-50, 50, (2000, 8))
    state = vc.Bounds.fresh(points, centres, 8)
    moved = centres + rng.integers(-20, 20, centres.shape)
    state, depth = vc.reassigned(points, moved, state.moved(np.sqrt(((moved - centres) ** 2).sum(1)) * 1.001), 8)
    assert (depth == 0).mean() > 0.9 and (depth > 8).mean() < 0.01


def test_b_adapts():
    depths = np.zeros(258, np.int64)
    depths[1:4] = [90, 6, 4]
    assert vc.adapted(32, depths, 256) == 8
    depths[20] = 30
    assert vc.adapted(32, depths, 256) == 20
    depths[33] = 10_000
    assert vc.adapted(32, depths, 256) == 64


def test_restored_vectors_are_near(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(500)]
    codes, books = vc.compressed(spark.createDataFrame(rows, SCHEMA), entries=64)
    given_ = {i: x for i, x, _ in rows}
    for r in vc.restored(codes, books).collect():
        d = np.floor(1024 * np.array(given_[r["vec_id"]])) - 1024 * np.array(r["embedding"])
        assert round((d**2).sum()) == r["error"]


def test_many_labels_are_joined_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), None if i % 3 == 0 else i % 5) for i in range(200)]
    monkeypatch.setattr(vc, "FEW_LABELS", 0)
    assert coded(spark, rows) == plain(rows)
