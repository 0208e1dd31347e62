import datetime as dt
import random

import pytest

from annalist import EntitySpec
from annalist.operators import conform
from annalist.operators.versions import build_versions
from annalist.streaming import ingest
from annalist.streaming.history import VersionedHistory, maintain_history

SCHEMA = "k string, d date, ts timestamp_ntz, a string"
SPEC = EntitySpec("k", "d", ("a",), ("-ts", "a"))


def rows(spark, *items):
    data = [
        (k, dt.date(2024, 1, n), dt.datetime(2024, 1, n, h), a) for k, n, h, a in items
    ]
    return spark.createDataFrame(data, SCHEMA)


FIRST = [("A", 5, 1, "x"), ("B", 5, 1, "x")]
LATE = [("A", 2, 1, "w"), ("B", 9, 1, "z")]
CORRECTION = [("A", 5, 8, "y")]


def deliver(spark, folder, *batches):
    for batch in batches:
        rows(spark, *batch).coalesce(1).write.mode("append").parquet(folder)


def history(spark, root, folder):
    store = VersionedHistory(spark, f"{root}/store", SPEC)
    stream = ingest.arriving_files(spark, folder, SCHEMA, "parquet", files_per_batch=1)
    run = maintain_history(stream, store, f"{root}/checkpoint")
    run.awaitTermination()
    return store, run


def test_stream_equals_batch_with_late_and_corrected_days(spark, tmp_path):
    root, folder = str(tmp_path), str(tmp_path / "in")
    deliver(spark, folder, FIRST, LATE, FIRST, CORRECTION)
    store, run = history(spark, root, folder)
    assert len(store.commits()) == run.lastProgress["batchId"] + 1 == 4
    full = build_versions(
        rows(spark, LATE[0], CORRECTION[0], FIRST[1], LATE[1]), SPEC, with_last_seen=True
    )
    assert sorted(map(tuple, store.dimension().collect())) == sorted(map(tuple, full.collect()))


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    store = VersionedHistory(spark, str(tmp_path / "store"), SPEC)
    store.apply(rows(spark, *FIRST), 0)
    store.apply(rows(spark, *LATE), 1)
    before = sorted(map(tuple, store.dimension(1).collect()))
    store.apply(rows(spark, *LATE), 1)
    assert sorted(map(tuple, store.dimension(1).collect())) == before


def test_each_file_is_ingested_once(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    for batch, expected in ((FIRST, 2), (LATE, 4)):
        deliver(spark, folder, batch)
        stream = ingest.arriving_files(spark, folder, SCHEMA, "parquet")
        ingest.ingest_available(stream, target, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(target).count() == expected


def test_fresh_checkpoint_goes_on_with_the_history(spark, tmp_path):
    """A stream that starts again reads its files again and must not lose what the store has."""
    root, folder = str(tmp_path), str(tmp_path / "in")
    deliver(spark, folder, FIRST, LATE)
    store, _ = history(spark, root, folder)
    before = sorted(map(tuple, store.dimension().collect()))
    second = str(tmp_path / "more")
    deliver(spark, second, [("C", 7, 1, "q")])
    stream = ingest.arriving_files(spark, second, SCHEMA, "parquet", files_per_batch=1)
    maintain_history(stream, store, f"{root}/fresh").awaitTermination()
    after = sorted(map(tuple, store.dimension().collect()))
    assert [r for r in after if r[0] != "C"] == before and len(after) == len(before) + 1
    assert {r.k for r in store.snapshots(99).collect()} == {"A", "B", "C"}
    assert not (tmp_path / "store" / "dimension" / "step=0").exists()


def test_lower_batch_of_a_run_is_refused_and_a_repeat_is_not(spark, tmp_path):
    store = VersionedHistory(spark, str(tmp_path / "store"), SPEC)
    assert [store.apply(rows(spark, *b), i) for i, b in ((0, FIRST), (5, LATE))] == [0, 1]
    assert store.apply(rows(spark, *FIRST), 0) == 0
    with pytest.raises(ValueError, match="older"):
        store.apply(rows(spark, *CORRECTION), 3)


def fresh(spark, folder, root):
    stream = ingest.arriving_files(spark, folder, SCHEMA, "parquet", files_per_batch=1)
    run = ingest.ingest_fresh(stream, f"{root}/out", f"{root}/cp", ["k", "d", "a"], "d")
    run.awaitTermination()
    return run, sorted((r.k, r.d.day, r.a) for r in ingest.stored_rows(spark, f"{root}/out").collect())


def test_redelivered_rows_are_dropped_and_corrections_pass(spark, tmp_path):
    folder = str(tmp_path / "in")
    deliver(spark, folder, FIRST, FIRST, CORRECTION)
    assert fresh(spark, folder, tmp_path)[1] == [("A", 5, "x"), ("A", 5, "y"), ("B", 5, "x")]


def test_no_row_is_lost_however_late(spark, tmp_path):
    """Each delivery is older than all before it, and there are more batches than progress records are kept."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    folder = str(tmp_path / "in")
    days = [28, 20, 15, 9, 3, 1]
    deliver(spark, folder, *[[("A", d, 1, "x"), ("B", d, 1, "y")] for d in days], [("A", 28, 1, "x")])
    run, landed = fresh(spark, folder, tmp_path)
    assert run.lastProgress["batchId"] + 1 == 7 > len(run.recentProgress)
    assert set(landed) == {(k, d, a) for d in days for k, a in (("A", "x"), ("B", "y"))} and len(landed) == 12
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet")) if folder.exists() else 0


def random_batches(seed, n, people=8):
    """Batches in which most days are new, some late, some corrected, some repeated."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = 2 + i
        out.append([(f"P{rng.randrange(people)}", day if rng.random() < 0.7 else rng.randrange(1, day + 1), h, rng.choice("xyz")) for h in range(rng.randrange(1, 7))])
    return out


@pytest.mark.parametrize("seed, fan", [(1, 2), (2, 3)])
def test_many_steps_with_merges_equal_a_full_build(spark, tmp_path, seed, fan):
    store = VersionedHistory(spark, str(tmp_path / "store"), SPEC, fan=fan)
    seen = []
    for i, batch in enumerate(random_batches(seed, 9)):
        store.apply(rows(spark, *batch), i)
        seen += batch
    full = build_versions(conform.one_row_per_day(rows(spark, *seen), SPEC), SPEC, with_last_seen=True)
    assert sorted(map(tuple, store.dimension().collect())) == sorted(map(tuple, full.collect()))
    manifest = store.versions.manifest(8)
    assert max(s.level for s in manifest) >= 1
    assert all(sum(s.kind == k and s.level == n for s in manifest) < fan for k in ("open", "closed", "rebuilt") for n in range(9))


def test_bytes_written_follow_the_batch_and_not_the_dimension(spark, tmp_path):
    """One step of ten entities writes as much into a dimension of 20,000 entities as into one of 200."""
    day, grown = dt.date(2024, 2, 1), {}
    for people in (200, 20_000):
        store = VersionedHistory(spark, str(tmp_path / f"store{people}"), SPEC)
        first = spark.range(people).selectExpr("concat('k', id) AS k", "DATE '2024-01-01' AS d", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "concat('a', id % 7) AS a")
        store.apply(first, 0)
        before = size(tmp_path / f"store{people}" / "dimension")
        few = first.limit(10).selectExpr("k", f"DATE '{day}' AS d", "ts", "'new' AS a")
        store.apply(few, 1)
        grown[people] = size(tmp_path / f"store{people}" / "dimension") - before
        assert before > 10 * grown[people] or people == 200
        assert store.dimension().count() == people + 10
    assert grown[20_000] < 1.2 * grown[200]


@pytest.mark.parametrize("where", ["written", "segments", "manifest", "commit"])
def test_a_step_that_fails_is_done_again(spark, tmp_path, monkeypatch, where):
    """Whatever a broken step has left behind, readers see the step before and the next try replaces it."""
    store = VersionedHistory(spark, str(tmp_path / "store"), SPEC, fan=2)
    batches = random_batches(3, 4)
    for i, batch in enumerate(batches[:3]):
        store.apply(rows(spark, *batch), i)
    before = sorted(map(tuple, store.dimension().collect()))

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if where == "written":
            patch.setattr("annalist.streaming.history.written", broken)
        elif where == "segments":
            patch.setattr(store.versions, "_merged", broken)
        elif where == "manifest":
            merged = store.versions._merged
            patch.setattr(store.versions, "_merged", lambda *a: merged(*a) and broken())
        else:
            patch.setattr(store, "_path", lambda kind, step, path=store._path: broken() if kind == "commits" else path(kind, step))
        with pytest.raises(RuntimeError, match="lost"):
            store.apply(rows(spark, *batches[3]), 3)
    assert sorted(map(tuple, store.dimension().collect())) == before
    store.apply(rows(spark, *batches[3]), 3)
    full = build_versions(conform.one_row_per_day(rows(spark, *sum(batches, [])), SPEC), SPEC, with_last_seen=True)
    assert sorted(map(tuple, store.dimension().collect())) == sorted(map(tuple, full.collect()))
