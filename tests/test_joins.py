"""Hot keys and reporting lines against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from annalist.operators import hierarchy
from annalist.operators.skew import hot_keys, salted_join
from annalist.sources import scratch


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    # A third of the left rows share one key, another third has none.
    left = [(i, rng.choice([1, 1, None, None, rng.randint(2, 40), rng.randint(2, 40)])) for i in range(900)]
    right = [(k, v) for k in range(0, 30) for v in range(k % 4)]
    return (
        spark.createDataFrame(left, "id int, k int"),
        spark.createDataFrame(right, "k int, v int"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(sides, how):
    left, right = sides
    assert not hot_keys(left, ["k"], hot_rows=5).isEmpty()
    plain = left.join(right, "k", how).select("id", "k", *(["v"] if how in ("inner", "left") else []))
    salted = salted_join(left, right, ["k"], how, hot_rows=5)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_salted_join_with_residual(sides):
    left, right = sides
    plain = left.join(right, (left.k == right.k) & (F.col("v") >= F.col("id") % 3), "left")
    salted = salted_join(left, right, ["k"], "left", F.col("v") >= F.col("id") % 3, hot_rows=5)
    a = sorted(repr((r.id, r.v)) for r in salted.collect())
    assert a == sorted(repr((r["id"], r["v"])) for r in plain.select("id", "v").collect())


def test_hot_key_list_is_bounded_and_split(sides):
    left, _ = sides
    hot = {r.k: r._parts for r in hot_keys(left, ["k"], hot_rows=50).collect()}
    assert set(hot) == {1, None} and hot[1] > 1
    assert hot_keys(left.limit(0), ["k"]).isEmpty()


def test_join_without_hot_keys_is_plain(sides):
    left, right = sides
    joined = salted_join(left, right, ["k"], "left")
    assert "_salt" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == left.join(right, "k", "left").count()


def test_unsupported_join_is_refused(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, ["k"], "right")


def brute_chain(edges, k):
    seen, cur, chain = {k}, k, []
    while True:
        boss = edges.get(cur)
        if boss is None:
            return chain, "root"
        if boss in seen:
            return chain, "cycle"
        chain.append(boss)
        seen.add(boss)
        cur = boss


@pytest.mark.parametrize("seed", range(3))
def test_chains_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = {f"E{i}": rng.choice([None, f"E{rng.randint(0, 70)}"] + [f"E{max(i - 1, 0)}"] * 6) for i in range(60)}
    df = spark.createDataFrame(list(edges.items()), "employee_id string, manager_id string")
    paths = hierarchy.manager_paths(df, "employee_id", "manager_id", hot_rows=5).collect()
    got = {r.employee_id: (list(r.path), r.ends_in) for r in paths}
    assert got == {k: brute_chain(edges, k) for k, m in edges.items() if m is not None}


def test_levels_limit_the_report_only(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d")]
    df = spark.createDataFrame(edges, "employee_id string, manager_id string")
    rows = hierarchy.reporting_chain(df, "employee_id", "manager_id", levels=1).collect()
    assert sorted((r.employee_id, r.ancestor, r.ends_in) for r in rows) == [
        ("a", "b", "root"),
        ("b", "c", "root"),
        ("c", "d", "root"),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_cycles_totals_and_lines_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = {f"E{i}": rng.choice([None, f"E{i}", f"E{rng.randint(0, 45)}"] + [f"E{max(i - 1, 0)}"] * 6) for i in range(40)}
    df = spark.createDataFrame(list(edges.items()), "employee_id string, manager_id string")
    chains = {k: brute_chain(edges, k)[0] for k, m in edges.items() if m is not None}

    def cycle_of(k):
        seen = []
        while k is not None and k not in seen:
            seen.append(k)
            k = edges.get(k)
        return seen[seen.index(k):] if k is not None else []

    on_cycle = {k: min(c) for k in edges if k in (c := cycle_of(k))}
    got = {r.node: r.cycle for r in hierarchy.cycles(df, "employee_id", "manager_id", hot_rows=5).collect()}
    assert got == on_cycle
    total, direct = {}, {}
    for path in chains.values():
        for level, boss in enumerate(path):
            total[boss] = total.get(boss, 0) + 1
            direct[boss] = direct.get(boss, 0) + (level == 0)
    rows = hierarchy.all_reports(df, "employee_id", "manager_id", hot_rows=5).collect()
    assert {r.manager_id: (r.direct_reports, r.all_reports) for r in rows} == {k: (direct[k], n) for k, n in total.items() if direct[k]}
    lines = {}
    for r in hierarchy.reporting_lines(df, "employee_id", "manager_id", hot_rows=5).collect():
        lines.setdefault(r.employee_id, []).append((r.level, r.ancestor, r.cycle))
    want = {}
    for k, path in chains.items():
        if k not in on_cycle:
            stop = next((i for i, b in enumerate(path) if b in on_cycle), len(path) - 1)
            want[k] = [(i + 1, b, on_cycle.get(b)) for i, b in enumerate(path[: stop + 1])]
    assert {k: sorted(v) for k, v in lines.items()} == want


def test_as_of_lookup_with_a_hot_key_and_missing_keys(spark):
    import datetime as dt

    from annalist.operators import asof

    rng = random.Random(3)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    versions = []
    for k in range(8):
        starts = sorted(rng.sample(range(100), 5))
        for i, s in enumerate(starts):
            end = day(starts[i + 1] - 1) if i < 4 else dt.date(9999, 12, 31)
            versions.append((k, day(s), day(s + 1) if k == 3 else end, f"{k}-{i}"))
    facts = [(i, 1 if i % 10 else rng.choice([None, *range(10)]), day(rng.randrange(120))) for i in range(600)]
    dim = spark.createDataFrame(versions, "k int, effective_start_date date, effective_end_date date, v string")
    df = spark.createDataFrame(facts, "id int, who int, d date")
    want = {
        i: next((v for k, a, b, v in versions if k == who and a <= d <= b), None) for i, who, d in facts
    }
    for hot in (10**6, 20):
        out = asof.as_of_versions(df, dim, "who", "d", "k", ["v"], hot_rows=hot)
        assert out.columns == ["id", "who", "d", "v"] and {r.id: r.v for r in out.collect()} == want
        inner = asof.as_of_versions(df, dim, "who", "d", "k", ["v"], "inner", hot_rows=hot)
        assert {r.id: r.v for r in inner.collect()} == {i: v for i, v in want.items() if v is not None}


def test_chain_around_long_cycles_is_listed_by_tasks_of_bounded_size(spark, monkeypatch):
    """A cycle of 20 with lines that enter it, a root with a line, someone who is their own manager."""
    monkeypatch.setattr(hierarchy, "BLOCK", 7)
    monkeypatch.setattr(hierarchy, "ROUND_ROWS", 60)
    managers = {i: (i + 1) % 20 for i in range(20)} | {100: 5, 101: 100, 102: 101, 103: 19, 200: 201, 202: 200, 300: 300, 301: 300}
    df = spark.createDataFrame(list(managers.items()) + [(201, None)], "employee_id long, manager_id long")
    got = hierarchy.reporting_chain(df, "employee_id", "manager_id")
    expected = []
    for e in managers:
        line, at = [], managers[e]
        while at is not None and at != e and at not in line:
            line.append(at)
            at = managers.get(at)
        expected += [(e, i, a, "root" if at is None else "cycle") for i, a in enumerate(line, 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    spread = {r[0] for r in got.select(F.spark_partition_id()).distinct().collect()}
    assert len(spread) > 4


@pytest.mark.parametrize("twice", [[(1, 2), (1, 2), (2, 3), (3, 1)], [(None, 1), (None, 1), (1, 2), (2, 1)]])
def test_chain_of_repeated_and_missing_employees(spark, twice):
    df = spark.createDataFrame(twice, "employee_id long, manager_id long")
    got = sorted(map(str, hierarchy.reporting_chain(df, "employee_id", "manager_id").collect()))
    paths = hierarchy.manager_paths(df, "employee_id", "manager_id")
    rows = paths.select("employee_id", "ends_in", F.posexplode("path").alias("p", "ancestor"))
    assert got == sorted(map(str, rows.select("employee_id", (F.col("p") + 1).alias("level"), "ancestor", "ends_in").collect()))
    assert got


def test_chain_keeps_no_table_of_its_rounds(spark):
    """Only what the result reads stays: not a table for each doubling of the jumps."""
    before = len(scratch._written)
    people = 300
    df = spark.range(people).select(F.col("id").alias("employee_id"), F.pmod(F.col("id") * 7 + 3, F.lit(people)).alias("manager_id"))
    got = hierarchy.reporting_chain(df, "employee_id", "manager_id")
    left = sorted(p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in scratch._written[before:])
    assert left == ["lines", "rings", "rounds"]
    managers = {i: (i * 7 + 3) % people for i in range(people)}
    expected = []
    for e in managers:
        line, at = [], managers[e]
        while at != e and at not in line:
            line.append(at)
            at = managers[at]
        expected += [(e, i, a, "cycle") for i, a in enumerate(line, 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_neighbours_around_a_cycle_lie_together(spark, tmp_path, monkeypatch):
    """Walkers and members of a pair of blocks in the order of their places, which files need little room for."""
    monkeypatch.setattr(hierarchy, "BLOCK", 64)
    df = spark.range(256).select((F.col("id") * 37 % 256).alias("employee_id"), ((F.col("id") + 1) * 37 % 256).alias("manager_id"))
    rows = hierarchy.reporting_chain(df, "employee_id", "manager_id").select(F.spark_partition_id().alias("p"), "employee_id", "level").collect()
    assert len(rows) == 256 * 255
    steps = [b.level - a.level for a, b in zip(rows, rows[1:]) if (a.p, a.employee_id) == (b.p, b.employee_id)]
    assert sum(s in (1, 2) for s in steps) > 0.9 * len(steps)
