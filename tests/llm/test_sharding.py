import pytest

from annalist.llm import sharding


def check(rows, out, limit):
    """Every shard fits, is no other's prefix, and was split off only where its parent did not fit."""
    assert sorted((r.doc_id, r.bytes) for r in out) == sorted((d, len((t or "").encode())) for d, t in rows)
    size, count = {}, {}
    for r in out:
        size[r.shard] = size.get(r.shard, 0) + r.bytes
        count[r.shard] = count.get(r.shard, 0) + 1
    small = {r.shard for r in out if not r.oversize}
    for r in out:
        assert r.shard_bytes == size[r.shard] and r.shard_docs == count[r.shard] and r.depth == len(r.shard)
        assert size[r.shard] <= limit or count[r.shard] == 1
        if r.oversize:
            assert r.bytes > limit
    for s in small:
        assert not any(s != o and o.startswith(s) for o in small)
        parent = s[:-1]
        assert not s or sum(size[o] for o in small if o.startswith(parent)) > limit


def shards(spark, rows, limit):
    return sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit).collect()


def test_buckets_split_only_where_they_do_not_fit(spark):
    rows = [(i, "x" * (i * 31 % 400)) for i in range(500)] + [(1000, "y" * 5000), (1001, None), (1002, "")]
    out = shards(spark, rows, 2000)
    check(rows, out, 2000)
    assert sum(r.oversize for r in out) == 1


def test_repeated_ids_are_split(spark):
    rows = [(7, "x" * 90)] * 150 + [(i, "z" * 50) for i in range(100, 150)]
    out = shards(spark, rows, 1000)
    check(rows, out, 1000)
    assert len({r.shard for r in out if r.doc_id == 7}) >= 14


def test_awkward_rows(odd, none):
    out = sharding.assign_shards(odd, 10_000).collect()
    assert len(out) == odd.count() and max(r.shard_bytes for r in out if not r.oversize) <= 10_000
    assert sharding.assign_shards(none).collect() == []


def test_files_by_shard(spark, tmp_path):
    rows = [(i, "x" * 100) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sharding.write_shards(docs, sharding.assign_shards(docs, 1500), str(tmp_path / "out"))
    folders = list((tmp_path / "out").glob("shard=*"))
    assert len(folders) >= 14 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def test_files_with_null_and_repeated_ids(spark, odd, tmp_path):
    """Every row is written once, in the shard it was given, whatever its id."""
    with pytest.raises(ValueError, match="null or repeated"):
        sharding.write_shards(odd, sharding.assign_shards(odd, 1_000), str(tmp_path / "no"))
    rows = sharding.numbered(odd, "at")
    placed = sharding.assign_shards(rows, 1_000, row="at")
    sharding.write_shards(rows, placed, str(tmp_path / "out"), row="at")
    out = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out"))
    read = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(read, key=str) == sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    given = {r.shard: r.shard_docs for r in placed.collect()}
    folders = {f.name.split("=")[1]: f for f in (tmp_path / "out").glob("shard=*")}
    assert {s: spark.read.parquet(str(f)).count() for s, f in folders.items()} == given
