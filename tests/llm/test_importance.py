import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import importance as imp
from tests.llm.plain import LOWER

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text, longest):
    words = PLAIN.findall((text or "").translate(LOWER))
    found = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) for f in found]


def plain(rows, target, longest=1, buckets=imp.BUCKETS, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) by the definition."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(h % buckets for h in runs(text, longest)[1])
    for text in target:
        t.update(h % buckets for h in runs(text, longest)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in s}
    out = []
    for doc_id, text in rows:
        n, found = runs(text, longest)
        weight = sum(gain[h % buckets] for h in found)
        out.append([n, doc_id, len(found), weight, weight + imp.noise(None if doc_id is None else str(doc_id))])
    able = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[1:], ranks.get(id(r))) for r in out), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9é -\n/{~\U0001f600")), st.just("x" * 200 + " é" * 90)), max_size=6), st.integers(1, 3))
def test_features_as_defined(texts, longest):
    bucket, row, words = imp.features(pa.array(texts, pa.string()), longest, 997)
    expected = [runs(t, longest) for t in texts]
    assert words.tolist() == [n for n, _ in expected]
    for i, (_, found) in enumerate(expected):
        assert sorted(bucket[row == i].tolist()) == sorted(h % 997 for h in found)


@pytest.mark.parametrize("longest", [1, 2])
def test_whole_result(spark, longest):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{rng.integers(60)}" for _ in range(rng.integers(0, 60)))) for i in range(400)]
    target = [" ".join(f"w{rng.integers(9)}" for _ in range(30)) for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (0, 10, 37, 100):
        got = imp.ranked(imp.scores(docs, goal, longest), percent=percent)
        assert rows_of(got) == plain(rows, target, longest, percent=percent)


def test_ties_repeated_rows_and_null_ids_at_the_cut(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 90 + [(None, text)] * 60 + [(8, text + " more")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    goal = spark.createDataFrame([("w1 w2",)], "text string")
    for percent in (3, 10, 50, 99):
        assert rows_of(imp.ranked(imp.scores(docs, goal), percent=percent)) == plain(rows, ["w1 w2"], percent=percent)


@settings(max_examples=12, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(-(2**62), 2**62) | st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=30), st.data())
def test_cutoff_keeps_the_first(spark, values, data):
    k = data.draw(st.integers(0, len(values)))
    df = spark.createDataFrame(values, "a long, b long")
    kept = sorted(tuple(r) for r in df.where(imp.cutoff(df, ["a", "b"], k)).collect())
    first = sorted(values)[:k]
    assert kept == sorted(v for v in values if first and v <= first[-1])


def test_awkward_rows(spark, odd, none):
    goal = spark.createDataFrame([(None,), ("one two three",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(imp.ranked(imp.scores(odd, goal), percent=50)) == plain(rows, [None, "one two three"], percent=50)
    assert imp.importance(none, goal).count() == 0
    assert imp.importance(odd, none.select("text")).where("weight IS NULL OR score IS NULL").count() == 0


def test_resampled_documents_keep_their_columns(spark, odd):
    docs = odd.withColumn("score", odd["n_chars"]).withColumn("rank", odd["lang"])
    drawn = imp.resampled(docs, odd.select("text"), percent=60)
    assert set(drawn.columns) == {*docs.columns, "weight"}
    wanted = [r for r in imp.ranked(imp.scores(odd, odd.select("text")), percent=60).collect() if r["rank"]]
    assert sorted(r["rank"] for r in drawn.collect()) == list(range(1, len(wanted) + 1))
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert all((r["doc_id"], r["text"]) in texts for r in drawn.collect())


def test_target_like_documents_are_preferred(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join((f"t{rng.integers(30)}" if i % 10 == 0 else f"u{rng.integers(30)}") for _ in range(40))) for i in range(500)]
    goal = spark.createDataFrame([(" ".join(f"t{i}" for i in range(30)),)] * 20, "text string")
    drawn = imp.importance(spark.createDataFrame(rows, "doc_id long, text string"), goal).where("rank IS NOT NULL").collect()
    assert len(drawn) == 50 and all(r["doc_id"] % 10 == 0 for r in drawn)
