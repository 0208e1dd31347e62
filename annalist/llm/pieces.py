"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is encoded as the pieces of the highest summed score. The file's own scores are ranks of merges,
whose sums mean nothing, so they only order the pieces; unless a vocabulary is given, scores are log
frequencies of the pieces in all documents (`fitted`): units are counted once, then every unit is cut
along its best path and the pieces are counted anew, ``FITS`` times. The first paths are those of the
fewest pieces, on equal numbers of the earlier merges. Every piece counts once more than it occurs, so one
that no document holds has the least score, but a finite one. Empty tables leave all pieces equal.

Spaces are written as the marker, and a
marker is put in front. A character that no piece covers costs ``UNKNOWN`` less than the worst piece
and comes out as its bytes (byte fallback). On equal scores the path found first, from the left and
over shorter pieces last, stays. Nothing else is changed in the text, so decoding gives it back exactly; a
marker character that is itself part of a text goes through byte fallback, too.

Pieces never reach over the place between a character and a marker behind it (checked when the
vocabulary is read), so a text falls apart into units - spaces with the word behind them - whose
best paths are independent. Distinct units are encoded many at a time with array operations and
kept, up to a bound in bytes, for the texts of the task that follow; long units take the same steps alone. Work and
memory for a unit grow linearly with its length.

A null text has null pieces, an empty one none. Repeated rows are encoded alike.
"""

from __future__ import annotations

import copy
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from annalist.llm.trie import DoubleArray
from annalist.sources.scratch import materialize

#: The public vocabulary the registered queries use.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN = 10.0
#: Units of up to this many bytes are encoded many at a time.
SHORT = 48
#: Bytes of distinct units and their pieces that a task keeps, with what Python needs to hold them.
KEPT = 64 << 20
#: About the bytes of an entry of a dictionary with a text and a byte string, beside their characters.
ENTRY = 180
#: Distinct units a task counts before it writes them down.
UNITS = 250_000
#: Rounds of counting pieces along best paths.
FITS = 2
#: Characters a process reads at most between two writes of its unit counts.
COUNTED = 1 << 25
_MARK = MARKER.encode()
_UNIT = re.compile(r"[\n▁]| *[^ \n▁]+| +")


#: Bytes of a character by its first byte.
_WIDTH = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])


class Vocabulary:
    """Pieces with scores; made on the driver and sent to tasks."""

    def __init__(self, pieces: list[tuple[bytes, float]], byte_ids: list[int], name: str) -> None:
        """``pieces`` by id, byte pieces and control pieces with an empty string; ``byte_ids`` of the 256 bytes."""
        self.name = name
        self.byte_ids = np.array(byte_ids, np.int32)
        self.bytes = [p for p, _ in pieces]
        for b, i in enumerate(byte_ids):
            self.bytes[i] = bytes([b])
        self.scores = np.array([s for _, s in pieces])
        normal = {p: i for i, (p, _) in enumerate(pieces) if p}
        self.trie = DoubleArray(normal)
        self.usual = np.array(sorted(normal.values()))
        self.unknown = float(min(self.scores[i] for i in normal.values())) - UNKNOWN
        crossing = [p for p in normal if _MARK in p.lstrip(b" ").replace(_MARK, b" ").lstrip(b" ").replace(b" ", _MARK)]
        if crossing or any(b"\n" in p for p in normal):
            raise ValueError(f"pieces that reach over a space or a line end: {crossing[:3]}")
        self.decoded = [p.replace(_MARK, b" ") if i not in set(byte_ids) else p for i, p in enumerate(self.bytes)]

    def with_scores(self, scores: np.ndarray) -> Vocabulary:
        """The same pieces with other scores, by id."""
        other = copy.copy(self)
        other.scores = np.asarray(scores, float)
        other.unknown = float(other.scores[self.usual].min()) - UNKNOWN
        other.name = f"{self.name}#{xxhash.xxh3_128_hexdigest(other.scores.tobytes())}"
        return other


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces with the scores of the file, which are merge ranks in a BPE model; see `fitted`."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        usual = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        pieces.append((piece.encode() if usual else b"", model.get_score(i)))
    return Vocabulary(pieces, byte_ids, path)


def best_paths(units: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Ids, as 32-bit numbers in a byte string, of units in which spaces are markers.

    All units stand one behind the other. The trie is walked from all their characters at once, a byte
    further in each step; then the pieces found are tried in the order of their starts within the units,
    those with the same start, which end in different places, together.
    """
    trie, scores = vocabulary.trie, vocabulary.scores
    lengths = np.array([len(u) for u in units])
    codes = np.frombuffer(b"".join(units), np.uint8)
    unit = np.repeat(np.arange(len(units)), lengths)
    after = np.cumsum(lengths)
    limit, within = after[unit], np.arange(len(codes)) - (after - lengths)[unit]
    width = _WIDTH[codes]
    start = np.flatnonzero((codes & 0xC0) != 0x80)
    lone = np.zeros(len(codes), bool)
    lone[start] = True
    at, state = start, np.zeros(len(start), np.int64)
    starts, ends, ids = [], [], []
    while len(start):
        state, there = trie.step(state, codes[at])
        start, at, state = start[there], at[there] + 1, state[there]
        number = trie.value[state]
        hit = np.flatnonzero(number >= 0)
        starts.append(start[hit])
        ends.append(at[hit])
        ids.append(number[hit])
        lone[start[hit][at[hit] - start[hit] == width[start[hit]]]] = False
        more = at < limit[start]
        start, at, state = start[more], at[more], state[more]
    # Characters that no piece covers alone.
    alone = np.flatnonzero(lone)
    starts = np.concatenate([*starts, alone])
    ends = np.concatenate([*ends, np.minimum(alone + width[alone], limit[alone])])
    ids = np.concatenate([*ids, np.full(len(alone), -1)])
    weights = np.where(ids >= 0, scores[ids], vocabulary.unknown)
    order = np.argsort(within[starts].astype(np.uint16), kind="stable")
    starts, ends, ids, weights = starts[order], ends[order], ids[order], weights[order]
    # A unit of n bytes has n + 1 cells, for the places between its bytes.
    origin, cell = starts + unit[starts], ends + unit[starts]
    first, last = after - lengths + np.arange(len(units)), after + np.arange(len(units))
    best = np.full(len(codes) + len(units), -np.inf)
    best[first] = 0
    piece, came = np.full(len(best), -1), np.zeros(len(best), np.int64)
    cuts = np.cumsum(np.bincount(within[starts])).tolist()
    for low, high in zip([0, *cuts], cuts, strict=False):
        score = best[origin[low:high]] + weights[low:high]
        up = np.flatnonzero(score > best[cell[low:high]])
        to = cell[low:high][up]
        best[to], piece[to], came[to] = score[up], ids[low:high][up], origin[low:high][up]
    return _walked_back(codes, first, last, piece, came, vocabulary)


def _walked_back(
    codes: np.ndarray, first: np.ndarray, last: np.ndarray, piece: np.ndarray, came: np.ndarray, vocabulary: Vocabulary
) -> list[bytes]:
    """The ids on the best path of each unit, from the piece that ends in each cell and the cell it starts in."""
    inside, on_path = np.ones(len(piece), bool), np.zeros(len(piece), bool)
    inside[first] = False
    cells = last[inside[last]]
    while len(cells):
        on_path[cells] = True
        cells = came[cells]
        cells = cells[inside[cells]]
    cells = np.flatnonzero(on_path)
    number = np.searchsorted(last, cells)
    # A character without a piece has an id for each of its bytes.
    often = np.where(piece[cells] >= 0, 1, cells - came[cells])
    ids = np.repeat(piece[cells], often)
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        begin = np.repeat(came[cells] - number, often)
        behind = np.arange(len(ids)) - np.repeat(np.cumsum(often) - often, often)
        ids[unknown] = vocabulary.byte_ids[codes[(begin + behind)[unknown]]]
    raw = ids.astype(np.int32).tobytes()
    ends = (4 * np.cumsum(np.bincount(number, often, len(first)))).astype(np.int64).tolist()
    return [raw[low:high] for low, high in zip([0, *ends], ends, strict=False)]


def long_path(unit: bytes, vocabulary: Vocabulary) -> bytes:
    """As ``best_paths`` for one unit of any length, in memory proportional to it."""
    trie, scores = vocabulary.trie, vocabulary.scores
    base, check, value = trie.base, trie.check, trie.value
    n = len(unit)
    best, piece, came = [-np.inf] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    s = 0
    while s < n:
        lead = unit[s]
        width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        state, covered = 0, False
        for e in range(s, min(n, s + trie.longest)):
            to = base[state] + unit[e] + 1
            if check[to] != state:
                break
            state = to
            k = value[state]
            if k >= 0:
                covered |= e + 1 - s == width
                score = best[s] + scores[k]
                if score > best[e + 1]:
                    best[e + 1], piece[e + 1], came[e + 1] = score, int(k), s
        after = min(n, s + width)
        if not covered and best[s] + vocabulary.unknown > best[after]:
            best[after], piece[after], came[after] = best[s] + vocabulary.unknown, -1, s
        s = after
    parts, at = [], n
    while at:
        start = came[at]
        parts.append([piece[at]] if piece[at] >= 0 else vocabulary.byte_ids[list(unit[start:at])].tolist())
        at = start
    return np.array([i for part in reversed(parts) for i in part], np.int32).tobytes()


class Encoder:
    """Encodes texts, keeping the distinct units it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _paths(self, units: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        missing = set(units)
        if MARKER in missing:
            missing.remove(MARKER)
            yield MARKER, self.vocabulary.byte_ids[list(_MARK)].tobytes()
        new = sorted(missing, key=len)
        raw = [u.replace(" ", MARKER).encode() for u in new]
        fits = [len(r) <= SHORT for r in raw]
        yield from ((u, long_path(r, self.vocabulary)) for u, r, f in zip(new, raw, fits, strict=True) if not f)
        new, raw = list(compress(new, fits)), list(compress(raw, fits))
        for at in range(0, len(new), 4096):
            yield from zip(new[at : at + 4096], best_paths(raw[at : at + 4096], self.vocabulary), strict=True)

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as 32-bit numbers in a byte string."""
        cut = [None if t is None else _UNIT.findall(" " + t) if t else [] for t in texts]
        units = set().union(*filter(None, cut))
        for unit, path in self._paths(units.difference(self.known)):
            self.known[unit] = path
            self.size += len(unit) + len(path) + ENTRY
        look = self.known.__getitem__
        ids = [None if units is None else b"".join(map(look, units)) for units in cut]
        if self.size > KEPT:
            self.known, self.size = {}, 0
        return ids


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of ids: markers are spaces, bytes are themselves, the marker in front goes."""
    text = b"".join(map(vocabulary.decoded.__getitem__, ids))
    return text[1:].decode("utf-8", "replace") if text.startswith(b" ") else text.decode("utf-8", "replace")


#: Texts encoded at once.
GROUP = 200


def unit_counts(docs: DataFrame) -> DataFrame:
    """(unit, n): how often each unit, with markers for spaces, stands in the texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        read = 0

        def rows() -> pa.RecordBatch:
            units = [u.replace(" ", MARKER) for u in total]
            return pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(list(total.values()), pa.int64())], names=["unit", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                for text in batch.column("text").slice(at, GROUP).to_pylist():
                    if text:
                        units = _UNIT.findall(" " + text)
                        total.update(u for u in units if u != MARKER) if MARKER in text else total.update(units)
                        read += len(text)
                    if len(total) > UNITS or read > COUNTED:
                        yield rows()
                        total, read = Counter(), 0
        yield rows()

    return docs.select("text").mapInArrow(counted, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def piece_counts(units: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each piece, by id, stands on the best paths of all units."""
    size = len(vocabulary.scores)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            raw = [u.encode() for u in batch.column("unit").to_pylist()]
            n = batch.column("n").to_numpy()
            order = sorted((i for i in range(len(raw)) if len(raw[i]) <= SHORT), key=lambda i: len(raw[i]))
            groups = [order[at : at + 4096] for at in range(0, len(order), 4096)]
            done = [(g, best_paths([raw[i] for i in g], vocabulary)) for g in groups]
            done += [([i], [long_path(u, vocabulary)]) for i, u in enumerate(raw) if len(u) > SHORT]
            for group, paths in done:
                often = np.repeat(n[group], [len(p) // 4 for p in paths])
                total += np.bincount(np.frombuffer(b"".join(paths), np.int32), often, size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there].astype(np.int64))], names=["piece", "n"])

    rows = units.mapInArrow(counted, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["piece"]] = r["n"]
    return out


def fitted(docs: DataFrame, vocabulary: Vocabulary | None = None) -> Vocabulary:
    """``vocabulary`` with the log frequencies of its pieces in all texts as scores."""
    vocabulary = vocabulary or read_vocabulary()
    units = materialize(unit_counts(docs), "piece-units")
    usual = vocabulary.usual
    scores = np.zeros(len(vocabulary.scores))
    # Fewest pieces first; the order of merges weighs too little to make up for a piece more.
    scores[usual[np.argsort(-vocabulary.scores[usual], kind="stable")]] = -1 - 1e-3 * np.arange(len(usual)) / len(usual)
    for _ in range(FITS):
        n = piece_counts(units, vocabulary.with_scores(scores))[usual] + 1
        scores[usual] = np.log(n / n.sum())
    return vocabulary.with_scores(scores)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` with pieces (ids), n_pieces, and restored: whether decoding gives the text back.

    Without a vocabulary the public one is fitted to ``docs``."""
    vocabulary = vocabulary or fitted(docs)
    added = {"pieces", "n_pieces", "restored"}
    docs = docs.select(*[F.col(c) for c in docs.columns if c not in added])

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                texts = part.column("text").to_pylist()
                ids = encoder.encode(texts)
                values = np.frombuffer(b"".join(x or b"" for x in ids), np.int32)
                sizes = np.array([len(x or b"") // 4 for x in ids], np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([x is None for x in ids]))
                restored = [t is None or decode(values[a:b].tolist(), vocabulary) == t for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(sizes.astype(np.int64)), pa.array(restored)],
                    names=[*part.schema.names, "pieces", "n_pieces", "restored"],
                )

    schema = StructType([
        *docs.schema.fields,
        StructField("pieces", ArrayType(IntegerType())),
        StructField("n_pieces", LongType()),
        StructField("restored", BooleanType()),
    ])
    return docs.mapInArrow(done, schema)


def decode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` with text made from pieces; null where pieces are null."""
    vocabulary = vocabulary or read_vocabulary()
    rest = [c for c in docs.columns if c != "text"]

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else decode(x, vocabulary) for x in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    rows = docs.select(*rest)
    return rows.mapInArrow(done, StructType([*rows.schema.fields, StructField("text", StringType())]))


def encoded(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return encode_documents(docs.select("doc_id", "text")).select("doc_id", "pieces", "n_pieces", "restored")
