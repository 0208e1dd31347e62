import datetime as dt
import random

import pytest

from annalist.operators import intervals, sweeps
from pyspark.sql import functions as F

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(n)


def test_headcount_equals_counting_every_day(spark):
    rng = random.Random(1)
    rows = [(f"k{i}", day(a), day(a + rng.randrange(30)) if rng.random() < 0.7 else dt.date(9999, 12, 31), rng.choice("ab"), rng.random() < 0.8) for i in range(80) for a in [rng.randrange(60)]]
    dim = spark.createDataFrame(rows, "k string, effective_start_date date, effective_end_date date, g string, active boolean")
    got = sweeps.headcount_from_versions(dim, F.col("active"), F.lit(day(70)), ["g"])
    expected = set()
    for g in "ab":
        mine = [r for r in rows if r[3] == g and r[4]]
        for n in range((min(r[1] for r in mine) - START).days, 71):
            expected.add((day(n), g, sum(r[1] <= day(n) <= r[2] for r in mine)))
    assert set(map(tuple, got.collect())) == expected


def test_versions_are_not_expanded_to_days(spark):
    dim = spark.createDataFrame([], "k string, effective_start_date date, effective_end_date date, active boolean")
    plan = sweeps.headcount_from_versions(dim, F.col("active"), F.lit(day(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(sequence") < plan.index("Aggregate") < plan.index("Generate inline")


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_pairs_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), day(a), day(a + rng.randrange(-1, 6))) for _ in range(60) for a in [rng.randrange(30)]]
    rows += [("d", day(1), day(2)), ("d", day(3), day(4)), (None, day(1), day(9)), ("d", None, day(9)), ("e", day(5), day(5)), ("e", day(5), day(5))]
    dim = spark.createDataFrame(rows, "k string, effective_start_date date, effective_end_date date")
    proper = [r for r in rows if None not in r and r[1] <= r[2]]
    expected = {}
    for i, x in enumerate(proper):
        for y in proper[:i]:
            if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]:
                expected[x[0]] = expected.get(x[0], 0) + 1
    assert {r.k: r.overlapping_pairs for r in sweeps.overlapping_pairs(dim, "k").collect()} == expected


@pytest.mark.parametrize("seed, n, hub", [(1, 40, 0.0), (2, 60, 0.5), (3, 25, 0.0)])
def test_intervals_tell_who_is_below_whom(spark, seed, n, hub):
    """Random managers: trees, a manager of half of all, and cycles; a cycle is cut above its smallest member."""
    rng = random.Random(seed)
    boss = {i: (0 if rng.random() < hub else rng.randrange(n)) for i in range(1, n) if rng.random() < 0.9}
    boss[n + 5] = n + 5  # manages themself
    edges = spark.createDataFrame(list(boss.items()), "k long, m long").repartition(3)
    got = {r.node: r for r in intervals.subtree_intervals(edges, "k", "m").collect()}
    parent = dict(boss)
    for i in list(boss):
        path, at = [i], boss[i]
        while at in boss and at not in path:
            path.append(at)
            at = boss[at]
        if at == i:
            parent.pop(min(path), None)
    people = set(boss) | set(boss.values())
    assert set(got) == people

    def above(i):
        out = []
        while i in parent:
            i = parent[i]
            out.append(i)
        return out

    for i in people:
        chain = above(i)
        assert got[i].level == len(chain) and got[i].parent == parent.get(i)
        assert {j for j in people if got[j].enter < got[i].enter and got[i].leave < got[j].leave} == set(chain)
    places = sorted(x for r in got.values() for x in (r.enter, r.leave))
    assert places == list(range(1, 2 * len(people) + 1))


def test_no_edges(spark):
    assert intervals.subtree_intervals(spark.createDataFrame([], "k long, m long"), "k", "m").collect() == []
