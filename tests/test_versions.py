"""Change detection and versions on hand-made rows, and properties on the orders."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from annalist import EntitySpec
from annalist.operators import asof, conform, facts, incremental, keys, versions
from annalist.plans import history as H
from annalist.plans.inputs import EVENTS_SPEC, ORDERS_SPEC

SF = "/root/testdata/sf0.01"
SPEC = EntitySpec("k", "d", ("a", "b"), ("-ts", "a", "b"))
OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def snap(spark, rows):
    """rows: (key, day number, a, b)"""
    data = [(k, day(d), a, b, 0) for k, d, a, b in rows]
    return spark.createDataFrame(data, "k string, d date, a string, b string, ts int")


def build(spark, rows, **changes):
    dim = versions.build_versions(snap(spark, rows), SPEC.with_(**changes), with_last_seen=True)
    out = dim.orderBy("k", "effective_start_date").collect()
    return [
        (r.k, r.effective_start_date, r.effective_end_date, r.is_current, r.a, r.b) for r in out
    ]


def test_single_day(spark):
    assert build(spark, [("A", 1, "x", "y")]) == [("A", day(1), OPEN, True, "x", "y")]


def test_no_change(spark):
    rows = [("A", d, "x", "y") for d in (1, 2, 3)]
    assert build(spark, rows) == [("A", day(1), OPEN, True, "x", "y")]


def test_change_bridges_missing_days(spark):
    rows = [("A", 1, "x", "y"), ("A", 2, "x", "y"), ("A", 5, "z", "y")]
    assert build(spark, rows) == [
        ("A", day(1), day(4), False, "x", "y"),
        ("A", day(5), OPEN, True, "z", "y"),
    ]


def test_return_gives_three_versions(spark):
    rows = [("A", 1, "x", "y"), ("A", 2, "z", "y"), ("A", 3, "x", "y")]
    assert [v[4] for v in build(spark, rows)] == ["x", "z", "x"]


def test_absent_entity_stays_current(spark):
    rows = [("A", 1, "x", "y"), ("B", 1, "x", "y"), ("B", 90, "x", "y")]
    assert all(v[3] for v in build(spark, rows))


def test_last_seen_and_closing_of_absent(spark):
    rows = [("A", 1, "x", "y"), ("A", 3, "x", "y"), ("B", 1, "x", "y"), ("B", 9, "z", "y")]
    dim = versions.build_versions(snap(spark, rows), SPEC, with_last_seen=True)
    seen = {(r.k, r.a): r.last_seen_date for r in dim.collect()}
    assert seen == {("A", "x"): day(3), ("B", "x"): day(1), ("B", "z"): day(9)}
    closed = versions.close_absent(dim, F.lit(day(9))).orderBy("k", "effective_start_date").collect()
    assert [(r.k, r.effective_end_date, r.is_current) for r in closed] == [
        ("A", day(3), False),
        ("B", day(8), False),
        ("B", OPEN, True),
    ]


def test_null_moving_between_neighbours(spark):
    rows = [("A", 1, "x", None), ("A", 2, None, "x")]
    # The joined texts are equal, and the one version shows the first value of each column.
    assert build(spark, rows) == [("A", day(1), OPEN, True, "x", "x")]
    assert len(build(spark, rows, null_safe=True)) == 2


def test_empty_text_is_not_null(spark):
    assert len(build(spark, [("A", 1, "", "y"), ("A", 2, None, "y")])) == 2


def test_separator_in_value(spark):
    rows = [("A", 1, "x|y", "z"), ("A", 2, "x", "y|z")]
    assert len(build(spark, rows)) == 1
    assert len(build(spark, rows, null_safe=True)) == 2


def test_first_event_has_no_previous_values(spark):
    rows = [("A", 1, "x", "y"), ("A", 2, "z", "y")]
    ev = versions.change_events(snap(spark, rows), SPEC).orderBy("event_date").collect()
    assert [(e.prev_a, e.a, e.prev_b, e.b) for e in ev] == [
        (None, "x", None, "y"),
        ("x", "z", "y", "y"),
    ]


def test_change_log_has_one_row_per_attribute(spark):
    rows = [("A", 1, "x", "y"), ("A", 2, "z", None), ("A", 3, "z", None)]
    log = versions.change_log(snap(spark, rows), SPEC).collect()
    assert sorted((e.event_type, e.previous_value, e.new_value) for e in log) == [
        ("a_changed", "x", "z"),
        ("b_changed", "y", None),
    ]


def test_dates_must_be_days(spark):
    df = snap(spark, [("A", 1, "x", "y")]).withColumn("d", F.col("d").cast("timestamp"))
    with pytest.raises(ValueError, match="must be a date"):
        versions.build_versions(df, SPEC)


def test_key_order_is_text_order(spark):
    df = spark.createDataFrame([("E999",), ("E1000",)], "k string")
    got = {r.k: r.sk for r in keys.dense_keys(df, ["k"], "sk").collect()}
    assert got == {"E1000": 1, "E999": 2}


def test_dense_keys_notice_unordered_partitions(spark):
    df = spark.range(1000).repartition(8, "id")
    got = keys.dense_keys(df, ["id"], "sk", ranged=True).collect()
    assert len(got) == 1000 and all(r.sk == r.id + 1 for r in got)


def test_dense_keys_of_nothing(spark):
    assert keys.dense_keys(spark.range(0), ["id"], "sk").count() == 0


# Brute force: a plain loop over random histories.


def brute(rows, null_safe):
    out = []
    for k in sorted({r[0] for r in rows}):
        mine = sorted(r for r in rows if r[0] == k)
        for _, d, a, b in mine:
            mark = (a, b) if null_safe else "|".join(x for x in (a, b) if x is not None)
            if out and out[-1]["k"] == k and out[-1]["mark"] == mark:
                cur = out[-1]
                cur["a"] = a if cur["a"] is None else cur["a"]
                cur["b"] = b if cur["b"] is None else cur["b"]
                continue
            if out and out[-1]["k"] == k:
                out[-1].update(end=day(d - 1), current=False)
            out.append(dict(k=k, mark=mark, start=day(d), end=OPEN, current=True, a=a, b=b))
    return [(v["k"], v["start"], v["end"], v["current"], v["a"], v["b"]) for v in out]


def random_rows(seed):
    rng = random.Random(seed)
    values = [None, "", "x", "y", "x|y"]
    taken = {(rng.choice("ABCDEF"), rng.randint(1, 40)) for _ in range(150)}
    return [(k, d, rng.choice(values), rng.choice(values)) for k, d in sorted(taken)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("null_safe", [False, True])
def test_versions_equal_brute_force(spark, seed, null_safe):
    rows = random_rows(seed)
    assert build(spark, rows, null_safe=null_safe) == brute(rows, null_safe)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("null_safe", [False, True])
def test_any_order_of_arrival_gives_the_full_build(spark, seed, null_safe):
    spec = SPEC.with_(null_safe=null_safe)
    rows = random_rows(100 + seed)
    rng = random.Random(seed)
    batches = [[], [], []]
    for r in rows:
        batches[rng.randint(0, 2)].append(r)
    full = versions.build_versions(snap(spark, rows), spec, with_last_seen=True)
    dim = versions.build_versions(snap(spark, batches[0]), spec, with_last_seen=True)
    seen = list(batches[0])
    for batch in batches[1:]:
        seen += batch
        grown = incremental.apply_batch(dim, snap(spark, batch), spec, snap(spark, seen))
        dim = spark.createDataFrame(grown.collect(), full.schema)
    assert sorted(map(tuple, dim.collect())) == sorted(map(tuple, full.collect()))


def test_replaying_a_day_changes_nothing(spark):
    rows = random_rows(7)
    full = versions.build_versions(snap(spark, rows), SPEC, with_last_seen=True)
    last = max(d for _, d, _, _ in rows)
    batch = snap(spark, [r for r in rows if r[1] == last])
    again = incremental.apply_batch(full, batch, SPEC, snap(spark, rows))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, full.collect()))


def test_late_batch_without_history_is_refused(spark):
    dim = versions.build_versions(snap(spark, [("A", 5, "x", "y")]), SPEC, with_last_seen=True)
    with pytest.raises(ValueError, match="late"):
        incremental.apply_batch(dim, snap(spark, [("A", 3, "z", "y")]), SPEC)


def test_batch_on_time_does_not_read_the_history(spark, tmp_path):
    first, second = [("A", 1, "x", "y")], [("A", 2, "z", "y"), ("B", 2, "x", "y")]
    dim = versions.build_versions(snap(spark, first), SPEC, with_last_seen=True)
    snap(spark, first + second).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    grown = incremental.apply_batch(dim, snap(spark, second), SPEC, history)
    assert "FileScan" not in grown._jdf.queryExecution().executedPlan().toString()
    full = versions.build_versions(history, SPEC, with_last_seen=True)
    assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, full.collect()))


def test_same_day_correction_replaces_the_version(spark):
    old = snap(spark, [("A", 1, "x", "y"), ("A", 5, "bad", "y")])
    fix = snap(spark, [("A", 5, "x", "y")]).withColumn("ts", F.lit(9))
    dim = versions.build_versions(old, SPEC, with_last_seen=True)
    got = incremental.apply_batch(dim, fix, SPEC, old.unionByName(fix)).collect()
    assert [(r.a, r.effective_end_date) for r in got] == [("x", OPEN)]


# Properties and known counts on the orders.


@pytest.fixture(scope="module")
def orders(spark):
    return H.orders_snapshot(spark, SF).cache()


def test_known_counts(spark, orders):
    assert orders.count() == 14968
    count = lambda spec: versions.build_versions(orders, spec).count()
    assert count(ORDERS_SPEC) == 10481
    assert count(H.TWO) == 14071
    assert count(H.SHIFT) == 10481
    assert count(H.SHIFT.with_(null_safe=True)) == 12672


def test_events_and_versions_match_one_to_one(orders):
    dim = versions.build_versions(orders, H.TWO)
    events = versions.change_events(orders, H.TWO)
    a = dim.select("custkey", "effective_start_date", "hash_diff")
    b = events.select("custkey", "event_date", "tracked_hash")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_expansion_contains_every_snapshot(orders):
    dim = versions.build_versions(orders, ORDERS_SPEC)
    days = versions.expand_days(dim, ORDERS_SPEC, F.lit("2001-08-01").cast("date"))
    rows = orders.select("custkey", "day", "status")
    assert rows.exceptAll(days).isEmpty()


def test_every_snapshot_has_exactly_one_version(orders):
    dim = versions.build_versions(orders, ORDERS_SPEC)
    got = facts.with_version_key(
        orders.select("custkey", "day"), dim.withColumn("sk", F.lit(1)), ORDERS_SPEC, "sk"
    )
    assert got.count() == 14968 and got.filter("sk IS NULL").isEmpty()


def test_keyed_versions_equal_global_numbering(orders):
    keyed = versions.keyed_versions(orders, ORDERS_SPEC, "sk")
    rows = sorted((r.custkey, r.effective_start_date, r.sk) for r in keyed.collect())
    assert [r[2] for r in rows] == list(range(1, 10482))


def test_point_in_time_slice_has_one_row_per_known_entity(orders):
    cut = dt.date(1998, 6, 30)
    dim = versions.build_versions(orders, ORDERS_SPEC)
    known = orders.filter(F.col("day") <= F.lit(cut)).select("custkey").distinct().count()
    sliced = asof.as_of_day(dim, "1998-06-30")
    assert sliced.count() == known == sliced.select("custkey").distinct().count()


# Conforming.


def test_conflicting_rows_latest_load_wins(spark):
    rows = [("A", day(1), "old", "y", 1), ("A", day(1), "new", "y", 2), ("A", day(1), "new", "y", 2)]
    df = spark.createDataFrame(rows, "k string, d date, a string, b string, ts int")
    assert [r.a for r in conform.one_row_per_day(df, SPEC).collect()] == ["new"]


def test_latest_of_nothing_is_an_error(spark):
    with pytest.raises(ValueError):
        conform.history_and_latest(spark.createDataFrame([], "k string, d date"), "d")


# Plans.


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_and_no_python(spark):
    import __spark_entry__ as contract

    for name in ("scd2_full", "change_events_wide", "surrogate_keys", "fact_sk_lookup"):
        text = plan(contract.queries()[name](spark, SF))
        assert "SinglePartition" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_version_build_shuffles_once_for_days_and_once_for_entities(spark):
    text = plan(versions.build_versions(H.events_snapshot(spark, SF), EVENTS_SPEC))
    assert text.count("Exchange ") == 2
    assert "WindowGroupLimit" in text and "Partial" in text


def test_only_needed_columns_are_read(spark):
    text = plan(versions.build_versions(H.events_snapshot(spark, SF), EVENTS_SPEC))
    assert "props" not in text and "value" not in text
