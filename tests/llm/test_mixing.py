import math
import random

import pytest

from annalist.llm import mixing

SCHEMA = "doc_id long, source string, size long"


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing what is above the limits again and again."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        open_ -= over
    return target


def mixed(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()


def test_targets_and_words_taken(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", (i * 37) % 90 + 1) for i in range(3000)] + [(9000 + i, None, 4) for i in range(9)]
    out = mixed(spark, rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = filled(sizes)
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    for s, target in want.items():
        of = [r for r in out if r.source == s]
        assert all(math.isclose(r.target, target) and r.source_size == sizes[s] and 0 <= r.copies <= 3 for r in of)
        assert abs(sum(r.size * r.copies for r in of) - target) <= max(r.size for r in of) * 3


def test_copies_are_the_whole_numbers_crossed(spark):
    """Within a source the copies of the first k rows are floor(rate * k + offset) for every k."""
    rows = [(i, "a" if i % 4 else "b", i % 11) for i in range(400)]
    import hashlib

    out = mixed(spark, rows)
    for s in ("a", "b"):
        of = sorted((r for r in out if r.source == s), key=lambda r: (r.size, hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id))
        rate = of[0].target / of[0].source_size
        total = 0
        for k, r in enumerate(of, 1):
            total += r.copies
            assert abs(total - rate * k) < 1 + 1e-9


def test_repeated_rows_and_awkward_ones(spark, odd, none):
    rows = [(1, "a", 10)] * 500 + [(None, None, 0)] * 3 + [(2, "b", 10)] * 500
    out = mixed(spark, rows)
    assert len(out) == 1003
    one = [r.copies for r in out if r.doc_id == 1]
    assert len(set(one)) <= 2 and abs(sum(one) * 10 - out[0].target if out[0].source == "a" else 0) <= 30
    got = mixing.mixed(odd).collect()
    assert len(got) == odd.count() and all(r.taken == r.copies * r.size for r in got)
    assert mixing.mixed(none).collect() == []


def test_table_without_words(spark):
    assert [(r.target, r.size * r.copies) for r in mixed(spark, [(1, "a", 0), (2, "b", 0)])] == [(0.0, 0), (0.0, 0)]


def test_reruns_agree(spark):
    rows = [(i, f"s{i % 5}", i % 50) for i in range(500)]
    a, b = (sorted(map(tuple, mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(n)).collect())) for n in (2, 7))
    assert a == b


def test_documents_come_as_often_as_they_are_taken(odd, none):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and mixing.mixed_documents(none).collect() == []
    rows = {tuple(r) for r in odd.collect()}
    assert {tuple(r) for r in out.collect()} <= rows
    words = sum(len((r.text or "").split()) for r in odd.collect())
    taken = sum(len((r.text or "").split()) for r in out.collect())
    longest = max(len((r.text or "").split()) for r in odd.collect())
    assert abs(taken - words) <= 3 * longest


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 100, "c": 7}, {"a": 5}, {"a": 0, "b": 9, "c": 1, "d": 2, None: 3}])
def test_targets_against_sharing_again_and_again(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = filled(sizes)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in sizes)


@pytest.mark.parametrize("seed", range(4))
def test_small_sources_with_long_documents_come_within_three_percent(spark, seed):
    """50 documents a source, sizes from 1 to 20,000 words, most of them short; copies stay between 0 and 3."""
    rng = random.Random(seed)
    rows = [(50 * s + i, f"s{s:02}", int(20_000 ** rng.random())) for s in range(20) for i in range(50)]
    of = {}
    for r in mixed(spark, rows):
        of.setdefault(r.source, []).append(r)
    assert sorted(r.doc_id for x in of.values() for r in x) == list(range(1000))
    for docs in of.values():
        assert all(0 <= r.copies <= 3 for r in docs)
        assert abs(sum(r.size * r.copies for r in docs) / docs[0].target - 1) <= 0.03


def test_long_copies_reach_what_can_be_reached():
    """With short documents behind the long ones any target is reached to a word."""
    rng = random.Random(8)
    for _ in range(300):
        sizes = sorted((rng.randrange(1, 40) for _ in range(rng.randrange(1, 6))), reverse=True) + [1] * 30
        target = float(sum(n * rng.randrange(4) for n in sizes))
        got = mixing.long_copies(sizes, sum(sizes), target, rng.random())
        assert all(0 <= n <= 3 for n in got)
        assert abs(sum(n * c for n, c in zip(sizes, got, strict=True)) - target) <= 1
    assert mixing.long_copies([10], 10, 24.0, 0.9) == [2]
    assert mixing.long_copies([10, 5], 15, 45.0, 0.0) == [3, 3]


def test_long_documents_expect_their_share(spark):
    """Over many offsets a long document is taken as often as its source's target says."""
    for rate in (0.4, 1.0, 1.7, 2.6):
        total = [0, 0]
        for k in range(1000):
            for i, n in enumerate(mixing.long_copies([100, 90], 5000, rate * 5000, (k + 0.5) / 1000)):
                total[i] += n / 1000
        assert all(abs(t - rate) < 0.05 for t in total)
