import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from annalist import hr
from annalist.operators.incremental import batch_versions
from annalist.operators.keys import dense_keys
from annalist.operators.quality import QualityError
from annalist.operators.versions import build_versions
from annalist.plans import daily, jobs
from annalist.sources import scratch
from annalist.sources.releases import Releases, Stage

TABLES = ("silver_snapshot", "versions", "silver_base", "silver_events", "gold_static", "gold_scd2", "gold_changes", "gold_daily", "gold_reporting")


def rows(people, days, seed=0):
    """Raw rows as text: state changes now and then."""
    rng = random.Random(seed)
    out = []
    for day in days:
        for p in people:
            row = dict.fromkeys(hr.RAW_COLUMNS, "x") | {
                "employee_id": f"E{p}", "snapshot_date": str(dt.date(2024, 1, 1) + dt.timedelta(day)), "status": rng.choice(["active", "active", "on_leave"]),
                "team": rng.choice("ab"), "fte_flag": "1", "hire_date": "2020-01-01", "date_of_birth": "1990-02-03", "phone_number": f"+1-415-555-{1000 + p}",
                "work_email": f"e{p}@company.example", "home_address_postal_code": f"9{1000 + p}",
            }
            out.append(tuple(row[c] for c in hr.RAW_COLUMNS))
    return out


def land(spark, folder, data):
    schema = ", ".join(f"{c} string" for c in hr.RAW_COLUMNS)
    spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").option("header", True).csv(str(folder))
    return str(folder)


def state(releases, table, drop=("ingest_ts", "silver_ts", "source_file")):
    df = releases.read(table)
    return sorted(map(str, df.drop(*drop).collect()))


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("deliveries")
    first = land(spark, root / "first", rows(range(40), range(0, 40, 13), 1))
    # Three people: one new, one on time, one with a day before all that is known.
    second = land(spark, root / "second", rows([3], [50], 2) + rows([7], [20], 3) + rows([99], [50], 4))
    return first, second


@pytest.fixture(scope="module")
def whole(spark, deliveries, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("expected"))
    for path in deliveries:
        daily.deliver(spark, path, root, buckets=16, documented=True)
    return Releases(spark, root)


@pytest.fixture(scope="module")
def expected(whole):
    return {t: state(whole, t) for t in TABLES}


def test_deliveries_give_the_versions_of_a_full_build(spark, deliveries, whole):
    snapshot = hr.silver_snapshot(spark.read.option("header", True).csv([f"{d}/*.csv" for d in deliveries]))
    full = build_versions(snapshot, hr.SPEC, with_last_seen=True)
    got = whole.read("versions").drop("employee_sk")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select(got.columns).collect()))
    dim = whole.read("gold_scd2")
    assert not {"home_address_line1", "last_seen_date"} & set(dim.columns)
    assert all("*" in r.phone_number for r in dim.select("phone_number").collect())


def test_a_delivery_that_was_taken_in_changes_nothing(spark, deliveries, whole):
    before = whole.committed()
    assert daily.deliver(spark, deliveries[0], whole.root) == whole.record(0)["counts"] and whole.committed() == before


def test_only_touched_parts_are_written(spark, deliveries, tmp_path):
    releases = Releases(spark, str(tmp_path))
    daily.deliver(spark, deliveries[0], str(tmp_path), buckets=64)
    before = releases.manifest(0)
    keys = {r.employee_id: r.employee_sk for r in releases.read("versions").where("is_current").collect()}
    daily.deliver(spark, deliveries[1], str(tmp_path), buckets=64)
    after = releases.manifest(1)
    for table, most in (("versions", 3), ("gold_scd2", 3), ("silver_base", 1), ("gold_static", 1), ("silver_events", 3)):
        touched = [p for p, (n, _) in after[table].items() if n == 1]
        assert 1 <= len(touched) <= most
        assert all(after[table][p] == before[table][p] for p in before[table] if p not in touched)
    kept = {r.employee_id: r.employee_sk for r in releases.read("versions").where("is_current").collect()}
    assert all(kept[k] == keys[k] for k in keys if k not in ("E3", "E7"))


@pytest.mark.parametrize("at", [5, "commit"])
def test_a_load_that_breaks_is_repeated(spark, deliveries, expected, tmp_path, monkeypatch, at):
    """Wherever it breaks, readers stay on the release before, and the next try gives the same tables."""
    releases = Releases(spark, str(tmp_path))
    daily.deliver(spark, deliveries[0], str(tmp_path), buckets=16, documented=True)
    before = {t: state(releases, t) for t in ("gold_scd2", "gold_daily")}
    calls = []

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if at == "gate":
            patch.setattr(daily, "gate", broken)
        elif at == "commit":
            patch.setattr(Stage, "commit", broken)
        else:
            put = Stage.put
            patch.setattr(Stage, "put", lambda *a: (calls.append(1), put(*a))[1] if len(calls) < at else broken())
        with pytest.raises(RuntimeError, match="lost"):
            daily.deliver(spark, deliveries[1], str(tmp_path), buckets=16, documented=True)
    assert releases.last() == 0 and {t: state(releases, t) for t in before} == before
    daily.deliver(spark, deliveries[1], str(tmp_path), buckets=16, documented=True)
    assert {t: state(releases, t) for t in TABLES} == expected


def test_a_refused_delivery_leaves_readers_where_they_were(spark, deliveries, tmp_path):
    layout = jobs.Layout(location=str(tmp_path), daily=True, buckets=4)
    jobs.run_day(spark, deliveries[0], layout)
    before = state(Releases(spark, layout.releases), "gold_scd2")
    bad = [tuple("soon" if c == "snapshot_date" else v for c, v in zip(hr.RAW_COLUMNS, r)) for r in rows([1, 2], [60])]
    with pytest.raises(QualityError, match="readable date"):
        jobs.run_day(spark, land(spark, tmp_path / "bad", bad), layout)
    with pytest.raises(QualityError, match="2 rows"):
        jobs.run_day(spark, land(spark, tmp_path / "half", bad + rows([1], [60])), layout, rejected=1)
    assert state(Releases(spark, layout.releases), "gold_scd2") == before
    assert jobs.check_job(spark, layout).where("failures > 0").count() == 0


def test_no_task_grows_with_a_part(spark, tmp_path):
    """Rows of one part come from several tasks: where they lie, or split by size; a small part is one file."""
    data = spark.range(0, 40_000, 1, 8).selectExpr("id", "sha2(string(id), 512) AS text")
    files = {}
    stage = Releases(spark, str(tmp_path)).stage()
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for table, gather, limit in (("lying", False, "64m"), ("split", True, "256k"), ("small", True, "64m")):
        spark.conf.set(size, limit)
        try:
            assert stage.put(table, data, F.lit("p"), ["p"], gather) == 40_000
        finally:
            spark.conf.unset(size)
        files[table] = len(list((tmp_path / "tables" / table / "n=0" / "_part=p").glob("*.parquet")))
        assert stage.read(table).count() == 40_000
    assert files["lying"] == 8 and files["split"] > 2 and files["small"] == 1


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    assert [jobs.buckets_for(n, 4) for n in (0, 1_000_000, 1_000_001, 54_000_000)] == [4, 4, 8, 216]
    monkeypatch.setattr(jobs, "BUCKET_ROWS", 10)
    layout = jobs.Layout(location=str(tmp_path / "tables"), prefix="grown_", buckets=2)
    folder = land(spark, tmp_path / "csv", rows(range(20), [0, 3]))
    jobs.bronze_job(spark, folder, layout)
    jobs.silver_job(spark, layout)
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {layout.name('silver_snapshot')}").collect()}
    assert told["Num Buckets"] == "4"
    assert layout.read(spark, "silver_snapshot").count() == 40
    for table in ("bronze", "silver_snapshot", "silver_base", "silver_events"):
        spark.sql(f"DROP TABLE {layout.name(table)}")


def test_masks_are_built_behind_the_shuffle(spark, monkeypatch):
    """Not by the few tasks that read the files, and not a second time for the sample of the key's ranges."""
    placed = []
    monkeypatch.setattr(hr, "dense_keys", lambda df, order, name, ranged=False: placed.append((df, ranged)))
    people = spark.createDataFrame(rows([1, 2], [0]), ", ".join(f"{c} string" for c in hr.RAW_COLUMNS))
    hr.static_dimension(people, policy="full")
    plan = placed[0][0]._jdf.queryExecution().optimizedPlan().toString()
    assert placed[0][1] and plan.index("sha2") < plan.index("RepartitionByExpression")
    assert "sha2" not in plan[plan.index("RepartitionByExpression") :]


def test_ranged_keys_where_ranges_of_nulls_come_first(spark):
    data = spark.createDataFrame([(None,)] * 40 + [(i,) for i in range(40)], "k long").repartitionByRange(4, "k")
    got = dense_keys(data, ["k"], "sk", ranged=True)
    found = sorted(got.collect(), key=lambda r: r.sk)
    assert [r.sk for r in found] == list(range(1, 81)) and [r.k for r in found] == [None] * 40 + list(range(40))


def test_a_load_leaves_nothing_but_its_release(spark, deliveries, expected, tmp_path):
    """No scratch table stays, the files are let go when Bronze has them, and old copies go before new ones come."""
    before, taken, seen = list(scratch._written), [], []
    releases = Releases(spark, str(tmp_path))

    def landed(n):
        bronze = list(tmp_path.glob(f"tables/bronze/n={n}/_part=*/*.parquet"))
        taken.append((n, bool(bronze)))
        seen.append(len(list(tmp_path.glob("tables/silver_snapshot/n=0/_part=*"))))

    for n, path in enumerate([*deliveries, deliveries[0]]):
        daily.deliver(spark, path, str(tmp_path), buckets=16, documented=True, delivery=f"d{n}", landed=lambda n=n: landed(n))
        if n == 1:
            assert {t: state(releases, t) for t in TABLES} == expected
    assert scratch._written == before
    assert taken == [(0, True), (1, True), (2, True)]
    needed = {p for p, (n, _) in releases.manifest(1)["silver_snapshot"].items() if n == 0}
    assert seen[2] == len(needed) < seen[1]


def test_days_of_a_conformed_history_are_not_dealt_again(spark):
    """Versions of late employees are built with one shuffle of the history less."""
    day = "date '2024-01-01'"
    raw = hr.silver_snapshot(spark.createDataFrame(rows(range(4), [0, 3, 5]), ", ".join(f"{c} string" for c in hr.RAW_COLUMNS)))
    opened = build_versions(raw.where(f"snapshot_date > {day}"), hr.SPEC, with_last_seen=True).where("is_current")
    batch = raw.where(f"snapshot_date = {day}")
    one, two = (batch_versions(opened, batch, hr.SPEC, raw, conformed)[0] for conformed in (True, False))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    windows = [df._jdf.queryExecution().optimizedPlan().toString().count("Window [") for df in (one, two)]
    assert windows[0] < windows[1]
