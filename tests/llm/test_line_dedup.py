import hashlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import line_dedup
from annalist.llm.minimal_hash import MinimalHash, build
from tests.llm.plain import without_lines


def test_awkward_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in without_lines(rows)]
    assert sorted(map(tuple, line_dedup.line_counts(odd).collect()), key=str) == sorted(want, key=str)
    assert line_dedup.line_counts(none).collect() == []


def test_texts_without_the_lines_and_clashing_columns(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = line_dedup.without_repeated_lines(odd)
    assert out.schema == odd.schema
    got = sorted(((r.doc_id, r.text, r.n_chars, r["drop"]) for r in out.collect()), key=str)
    kept = [(d, None if t is None else k[3]) for (d, t), k in zip(rows, without_lines(rows), strict=True)]
    assert got == sorted(((d, t, None if t is None else len(t), "x") for d, t in kept), key=str)
    assert line_dedup.without_repeated_lines(none).collect() == []


def test_crowded_shards_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES", 20)
    rows = [(i, "\n".join(["a line that is in every document", f"a line that {i % 40} documents share", "short"])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in without_lines(rows)]
    assert sorted(map(tuple, line_dedup.line_counts(df).collect())) == sorted(want)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), np.uint64)
    numbers = MinimalHash(*build(keys))(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))


def test_length_counts_code_points():
    assert not line_dedup.long_enough("é".encode() * 19) and line_dedup.long_enough("é".encode() * 20)
    assert not line_dedup.long_enough("\U0001f600".encode() * 19) and line_dedup.long_enough("\U0001f600".encode() * 20)


def test_lines_that_share_half_their_hash(spark, monkeypatch):
    """Keys with one first half are told apart by the other, repeated ones and such that are not."""

    def weak(key):
        return (key[:1] * 8 if key[:1] in b"ab" else b"\x01" * 8) + xxhash.xxh3_64_digest(key)

    monkeypatch.setattr(line_dedup, "digest_of", weak)
    rows = [(i, "\n".join([f"{c} line that {i % k} share, number {k}" for c in "abcd" for k in (1, 2, 50)])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in without_lines(rows)]
    lines = [(i, *line_dedup.hash_of(key)) for i, t in rows for key in {line_dedup.key_of(x) for x in t.encode().split(b"\n")}]
    monkeypatch.setattr(line_dedup, "_line_hashes", lambda docs: spark.createDataFrame(lines, "doc_id long, high long, low long"))
    drops = {r.doc_id: r["drop"] for r in line_dedup.dropped_lines(df).collect()}
    got = [(i, *line_dedup.cleaned(t.encode(), drops.get(i))) for i, t in rows]
    assert [(d, n, k, hashlib.sha256(t).hexdigest()) for d, n, k, t in got] == want
