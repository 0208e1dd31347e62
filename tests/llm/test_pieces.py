import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import pieces
from annalist.llm.tables import documents
from annalist.llm.trie import DoubleArray


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary()


def small():
    units = [("a", -1.0), ("b", -1.5), ("ab", -2.0), ("▁a", -1.2), ("ba", -2.4), ("▁", -2.0), ("é", -3.0), ("aba", -3.1)]
    table = [(u.encode(), s) for u, s in units] + [(b"", 0.0)] * 256
    return pieces.Vocabulary(table, list(range(len(units), len(units) + 256)), "small")


def best_score(text, vocabulary):
    """The highest score over all ways to cut a text, by trying them all from the left."""
    marked = "▁" + text.replace(" ", "▁")
    score = {p.decode(): vocabulary.scores[i] for i, p in enumerate(vocabulary.bytes[: len(vocabulary.scores) - 256])}
    best = [0.0]
    for end in range(1, len(marked) + 1):
        ways = [best[a] + score[marked[a:end]] for a in range(end) if marked[a:end] in score]
        if marked[end - 1] not in score:
            ways.append(best[end - 1] + vocabulary.unknown)
        best.append(max(ways))
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab éz", min_size=1, max_size=14))
def test_paths_have_the_best_score(text):
    v = small()
    ids = np.frombuffer(pieces.Encoder(v).encode([text])[0], np.int32).tolist()
    assert pieces.decode(ids, v) == text
    known = [i for i in ids if i < len(v.scores) - 256]
    unknown = sum(c == "z" for c in text)
    assert np.isclose(sum(v.scores[i] for i in known) + unknown * v.unknown, best_score(text, v))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(text):
    v = _vocabulary()
    assert pieces.decode(np.frombuffer(pieces.Encoder(v).encode([text])[0], np.int32).tolist(), v) == text


_kept = {}


def _vocabulary():
    return _kept.setdefault("v", pieces.read_vocabulary())


def test_equal_to_another_unigram_on_the_same_pieces(spark, vocabulary):
    """A public library's unigram model over the same pieces and scores."""
    import sentencepiece
    from tokenizers import Tokenizer, models

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    by_byte = set(vocabulary.byte_ids.tolist())
    table = []
    for i in range(model.get_piece_size()):
        usual = bool(vocabulary.bytes[i]) or i in by_byte
        table.append((model.id_to_piece(i) if usual else f"<never{i}>", model.get_score(i)))
    other = Tokenizer(models.Unigram(table, unk_id=0, byte_fallback=True))
    texts = [r.text for r in documents(spark, "/root/testdata/sf0.001").select("text").collect()]
    for text, ids in zip(texts, pieces.Encoder(vocabulary).encode(texts), strict=True):
        if text and pieces.MARKER not in text:
            assert other.encode((" " + text).replace(" ", pieces.MARKER)).ids == np.frombuffer(ids, np.int32).tolist()


def test_short_and_long_units_take_the_same_path(vocabulary):
    units = [f"▁{w}".encode() for w in ("thereafter", "Éléphant", "zzzzqqqq", "\U0001f600x", "日本語", "a")]
    assert pieces.best_paths(units, vocabulary) == [pieces.long_path(u, vocabulary) for u in units]


def test_bound_on_kept_units(monkeypatch, vocabulary):
    monkeypatch.setattr(pieces, "KEPT", 5)
    texts = ["one two three four five six seven eight", "one nine ten two", None, ""]
    encoder = pieces.Encoder(vocabulary)
    for _ in range(3):
        ids = encoder.encode(texts)
        assert len(encoder.known) <= 5
        assert [x if x is None else pieces.decode(np.frombuffer(x, np.int32).tolist(), vocabulary) for x in ids] == texts


def test_awkward_rows(odd, none):
    out = pieces.encode_documents(odd)
    rows = out.collect()
    assert all(r.restored for r in rows)
    assert {r.doc_id: (r.pieces, r.n_pieces) for r in rows if r.doc_id in (1, 2)} == {1: (None, 0), 2: ([], 0)}
    back = sorted(((r.doc_id, r.text) for r in pieces.decode_documents(out).collect()), key=str)
    assert back == sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    assert pieces.encode_documents(none).collect() == []
    assert pieces.encode_documents(out).columns == out.columns


def test_trie_holds_its_strings_and_no_others():
    strings = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "ba", "é", "éa", "xyz", "xyw"])}
    trie = DoubleArray(strings)
    for w in [*strings, b"x", b"xy", b"c", b"abd", b"\xc3"]:
        state, alive = np.zeros(1, np.int64), True
        for c in w:
            state, there = trie.step(state, np.array([c]))
            alive = alive and bool(there[0])
        assert (int(trie.value[state[0]]) if alive else -1) == strings.get(w, -1)


def test_fitted_scores_keep_ordinary_words_whole(spark):
    """Sums of merge ranks cut both lines into 15 pieces; log frequencies do not, whether the words occur or not."""
    lines = ["international organization of governments", "unfortunately distributed systems"]
    known = spark.createDataFrame([(i, lines[i % 2] + "\n        indented") for i in range(50)], "doc_id long, text string").repartition(3)
    for docs in (known, documents(spark, "/root/testdata/sf0.001")):
        v = pieces.fitted(docs)
        assert (v.scores[v.usual] < 0).all() and np.isclose(np.exp(v.scores[v.usual]).sum(), 1)
        sizes = [len(x) // 4 for x in pieces.Encoder(v).encode(lines)]
        assert sizes[0] <= 5 and sizes[1] <= 4
        eight = np.frombuffer(pieces.Encoder(v).encode(["        indented"])[0], np.int32).tolist()
        assert len(eight) <= 5
    rows = pieces.encode_documents(known).collect()
    assert all(r.restored and r.n_pieces <= 12 for r in rows)


def test_pieces_are_counted_over_all_documents(spark):
    v = small()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["ab ab", "ba", "abaz ▁", None, "", "ab" * 40])], "doc_id long, text string").repartition(4)
    units = {r.unit: r.n for r in pieces.unit_counts(docs).collect()}
    assert units == {"▁ab": 2, "▁ba": 1, "▁abaz": 1, "▁": 1, "▁" + "ab" * 40: 1}
    plain = np.zeros(len(v.scores))
    for unit, n in units.items():
        np.add.at(plain, np.frombuffer(pieces.long_path(unit.encode(), v), np.int32), n)
    assert pieces.piece_counts(pieces.unit_counts(docs), v).tolist() == plain.tolist()
