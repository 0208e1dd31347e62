import hashlib
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import byte_bpe as bb

VOCABULARY = bb.read_vocabulary()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.entries, special_tokens={})
ALPHABET = "ab zé́'stllm .,!\n\t\r\x0b\x1c\x85\xa0 　　9½Ⅷ٣日本\U0001f600\x00<|endoftext|>"


def plain(rows):
    """Digests of rows (doc_id, text) by the library."""
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from(ALPHABET), max_size=30))
def test_pieces_split_as_the_whole_text(text):
    splitter = bb.Splitter(public_tokenizers.PATTERN)
    cut = [w for p in splitter.pieces(text) for w in splitter.words(p)]
    assert cut == regex.findall(public_tokenizers.PATTERN, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET + "theinger"), min_size=1, max_size=30), min_size=1, max_size=9))
def test_words_as_the_library(words):
    words = [w.encode() for w in words]
    for ids, word in zip(bb.encode_words(words, VOCABULARY), words, strict=True):
        assert ids.tolist() == LIBRARY._encode_single_piece(word)
        assert bb.encode_long(word, VOCABULARY).tolist() == bb.encode_short([word], VOCABULARY)[0].tolist()


def test_long_words():
    for word in (b"x" * 30_000, b"ab" * 9_000, "日本語".encode() * 2_000):
        assert bb.encode_long(word, VOCABULARY).tolist() == LIBRARY._encode_single_piece(word)


def test_numbers_come_back():
    import numpy as np

    n = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, (1 << 28) - 1])
    raw, size = bb._varints(n)
    assert bb._numbers(raw)[0].tolist() == n.tolist() and size.sum() == len(raw)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40))
def test_order_of_lists_comes_back(slices):
    import numpy as np

    order = np.argsort(np.array(slices, np.int64), kind="stable")
    assert bb._from_steps(bb._steps(order)).tolist() == order.tolist()


@pytest.mark.parametrize("block", [1, 3000, bb.BLOCK])
def test_documents_as_the_library(spark, odd, block):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = bb.digests(bb.encode_documents(odd, block_bytes=block))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_round_trip_and_columns(spark, odd, none):
    coded = bb.encode_documents(odd)
    assert coded.columns == [c for c in odd.columns if c not in ("text", "tokens")] + ["tokens", "n_tokens"]
    back = bb.decode_documents(coded).drop("tokens", "n_tokens")
    kept = odd.drop("tokens").select(back.columns)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)
    assert bb.encode_documents(none).count() == 0 and bb.byte_tokens(none).count() == 0


def test_null_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r["doc_id"]: (r["tokens"], r["n_tokens"]) for r in bb.encode_documents(docs).collect()} == {1: (None, 0), 2: ([], 0)}


def test_positions_are_not_shuffled(spark, odd):
    plan = bb.encode_documents(odd)._jdf.queryExecution().toString()
    assert plan.count("Exchange") == 2 * plan.count("REPARTITION_BY_NUM") and "Bucketed: true" in plan


def test_bytes_that_are_no_utf8_are_replaced(spark):
    one = VOCABULARY.bytes_ids[0xE9]
    df = spark.createDataFrame([(1, [int(one)])], "doc_id long, tokens array<int>")
    assert bb.decode_documents(df).first()["text"] == "�"
