"""Byte-level BPE encoding and decoding: each distinct word of the corpus is encoded once.

A text falls apart into words (pre-tokens) by a fixed pattern. Blocks of documents list their distinct
words and write every word's place in a text as the word's number in its block. The words of all
blocks meet in one shuffle on slices of the word's hash, where each distinct one is encoded once; the
ids go back to the blocks that asked, and a block's documents are put together by position. Texts are
read once and never shuffled; the numbers of the positions are written once, bucketed by block, and
not shuffled either. Words of a block that go to one slice travel as one row. A word as frequent as
one likes crosses the network once for each block that holds it, and slices share the words evenly;
a task keeps the distinct words of one slice at a time, of which there are ``SLICES`` for each of
its share.

Words are encoded many at a time, the pair of least rank merged first and the leftmost on ties, as
ranks demand; a word that is itself an entry is that entry. Pairs are looked up by ids: every way to
put an entry together from two entries counts. Words longer than ``SHORT`` bytes take the same steps
alone, with a heap, in time that grows little faster than their length.

Decoding joins the token-byte table: a table of fixed size in every task, from which the bytes of all
ids of a batch are gathered at once. Encoding and decoding gives back every text.

A null text has null tokens, an empty one none. Repeated rows are encoded alike, each for itself; ids
are only carried along, so null and repeated ids are as good as any. A very long text is one row of
a block of its own size. Empty tables give empty results. A column of ``docs`` named tokens or
n_tokens is replaced; other names cannot clash, as columns travel inside one struct.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from annalist.llm.texts import slices, text_bytes
from annalist.sources.scratch import scratch_path, scratch_tables

#: The public vocabulary and pattern the registered queries use.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes of text in a block, unless one text alone has more.
BLOCK = 1 << 24
#: Words of up to this many bytes are encoded many at a time.
SHORT = 40
#: Words encoded at once.
GROUP = 4096
#: Slices of hashes for each partition of the shuffle.
SLICES = 8
_NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Entries with ranks, read on the driver and sent to tasks; a rank is an id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = pattern
        self.entries = ranks
        size = max(ranks.values()) + 1
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.size = size
        self.id_type = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        pairs = {}
        for entry, rank in ranks.items():
            for cut in range(1, len(entry)):
                left, right = ranks.get(entry[:cut]), ranks.get(entry[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ids = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)
        by_id = [b""] * size
        for entry, rank in ranks.items():
            by_id[rank] = entry
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.ends = np.cumsum([len(x) for x in by_id])
        self.lengths = np.array([len(x) for x in by_id], np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of what two neighbours make, ``_NONE`` where they make nothing or one of them is -1."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ids[at], _NONE)


def read_vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """Ranks of a file (base64 of the entry's bytes, rank, one entry in a line) and the pattern of words."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, file)}
    return Vocabulary(ranks, pattern or public_tokenizers.PATTERN)


def encode_short(words: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of words of at least one byte each, all steps taken for all of them at once."""
    lengths = np.array([len(w) for w in words])
    wide = int(lengths.max())
    codes = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8).reshape(len(words), wide)
    ids = np.where(np.arange(wide) < lengths[:, None], vocabulary.bytes_ids[codes], -1)
    left = lengths.copy()
    ids = np.concatenate([ids, np.full((len(words), 1), -1)], axis=1)
    rank = vocabulary.merged(ids[:, :-1], ids[:, 1:])
    rows = np.arange(len(words))
    sub, ranks = ids, rank  # of the words that may still change
    columns = np.arange(wide)
    while len(rows):
        at = ranks.argmin(1)  # the leftmost of the least
        best = ranks[np.arange(len(rows)), at]
        going = best < _NONE
        if not going.all():
            ids[rows[~going]] = sub[~going]
            rows, sub, ranks, at, best = rows[going], sub[going], ranks[going], at[going], best[going]
            if not len(rows):
                break
        every = np.arange(len(rows))
        # What stands behind the pair moves up by one place.
        moved = np.minimum(columns + (columns > at[:, None]), wide)
        sub = np.concatenate([np.take_along_axis(sub, moved, 1), np.full((len(rows), 1), -1)], axis=1)
        sub[every, at] = best
        ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), wide - 1), 1)
        ranks[:, -1] = _NONE
        ranks[every, at] = vocabulary.merged(best, sub[every, at + 1])
        before = np.flatnonzero(at > 0)
        ranks[before, at[before] - 1] = vocabulary.merged(sub[before, at[before] - 1], best[before])
        left[rows] -= 1
    return [row[:n] for row, n in zip(ids, left.tolist(), strict=True)]


def encode_long(word: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """As ``encode_short`` for one word of any length."""
    entries = vocabulary.entries
    ids = vocabulary.bytes_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    # A part is named by its first byte; ``after`` is the first byte of the next one.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def rank(i: int) -> int | None:
        """Rank of what part ``i`` and the next one make."""
        return entries.get(word[i : after[after[i]]]) if after[i] < n else None

    heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        r, i = heapq.heappop(heap)
        if not alive[i] or rank(i) != r:
            continue
        j = after[i]
        ids[i], alive[j], after[i] = r, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (i, before[i]):
            if k >= 0 and (new := rank(k)) is not None:
                heapq.heappush(heap, (new, k))
    return np.array([ids[i] for i in range(n) if alive[i]], np.int64)


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of each word."""
    out: list[np.ndarray | None] = [None] * len(words)
    rest = []
    for i, word in enumerate(words):
        whole = vocabulary.entries.get(word)
        if whole is not None:
            out[i] = np.array([whole])
        elif len(word) > SHORT:
            out[i] = encode_long(word, vocabulary)
        else:
            rest.append(i)
    rest.sort(key=lambda i: len(words[i]))
    for at in range(0, len(rest), GROUP):
        group = rest[at : at + GROUP]
        for i, ids in zip(group, encode_short([words[i] for i in group], vocabulary), strict=True):
            out[i] = ids
    return out


class Splitter:
    """Words of texts by the pattern; pieces of a text between spaces are split once per call.

    Texts are cut at single spaces, where a word always ends: behind a character that is not white
    space, or before one. Texts with other spaces are cut before white space that follows
    something else.
    """

    def __init__(self, pattern: str) -> None:
        import regex

        self._find = regex.compile(pattern).findall
        self._awkward = re.compile(r"\s \s|\s \Z").search
        space = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self._units = re.compile(f"[{space}]*[^{space}]+|[{space}]+").findall

    def pieces(self, text: str) -> list[str]:
        """Parts of the text that can be split each for itself; a piece without mark stands behind a space."""
        if self._awkward(text):
            return ["\0 " + unit for unit in self._units(text)]
        parts = text.split(" ")
        first = parts[0]
        if first:
            parts[0] = "\0 " + first
            return parts
        return parts[1:]

    def words(self, piece: str) -> list[str]:
        """The words of a piece."""
        if piece.startswith("\0 "):
            return self._find(piece[2:])
        if piece.isalpha():
            return [" " + piece]
        if piece[:-1].isalpha() and piece[-1] in ".,;:!?":
            return [" " + piece[:-1], piece[-1]]
        return self._find(" " + piece)


def _varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^28 as bytes, seven bits each, the last one marked; and the bytes of each."""
    n = numbers.astype(np.uint32)
    size = 1 + (n >= 1 << 7).astype(np.int64) + (n >= 1 << 14) + (n >= 1 << 21)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(4):
        there = size > k
        out[ends[there] - 1 - k] = (n[there] >> np.uint32(7 * k)) & 127
    out[ends - 1] |= 128
    return out, size


def _numbers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of `_varints`, and the place of the last byte of each."""
    last = np.flatnonzero(raw & 128)
    size = np.diff(np.concatenate([[-1], last]))
    out = (raw[last] & 127).astype(np.int64)
    for k in range(1, 4):
        there = size > k
        out[there] |= (raw[last[there] - k] & 127).astype(np.int64) << (7 * k)
    return out, last


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType, missing: pa.Array | None = None) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind), mask=missing)


class _Block:
    """Numbers of the distinct words of a block in order of appearance."""

    def __init__(self, number: int, splitter: Splitter) -> None:
        self.number, self.splitter = number, splitter
        self.words: dict[str, int] = {}
        self.bytes = 0

    def positions(self, texts: list[str | None]) -> tuple[bytes, np.ndarray]:
        """The word numbers of all texts as bytes, and how many bytes each text has."""
        words, known = self.words, {}
        cut = [self.splitter.pieces(t) if t else [] for t in texts]
        flat: list[int] = []
        ends = [0]
        for piece in dict.fromkeys(p for pieces in cut for p in pieces):
            known[piece] = len(ends) - 1
            flat.extend(words.setdefault(w, len(words)) for w in self.splitter.words(piece))
            ends.append(len(flat))
        at = np.fromiter((known[p] for pieces in cut for p in pieces), np.int64, sum(map(len, cut)))
        bounds = np.array(ends)
        lengths = np.diff(bounds)[at] if len(at) else at
        raw, size = _varints(np.array(flat, np.int64)[ragged(bounds[at], lengths)] if len(at) else at)
        # Bytes of each text: those of its words, summed.
        per_text = np.array([len(p) for p in cut])
        n_words = np.add.reduceat(np.append(lengths, 0), np.minimum(np.cumsum(per_text) - per_text, len(lengths))) * (per_text > 0) if len(cut) else per_text
        sums = np.concatenate([[0], np.cumsum(size)])
        last = np.cumsum(n_words)
        return raw.tobytes(), sums[last] - sums[last - n_words]


def _blocks(docs: DataFrame, vocabulary: Vocabulary, block_bytes: int, slices_: int) -> DataFrame:
    """Rows of three kinds: a document (slice null; row, positions, null for a null text), words of a
    block that fall into a slice (slice, sizes, words), and, at slice -1, the numbers of a block's words
    in the order of these lists (positions)."""
    pattern = vocabulary.pattern

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(pattern)
        block = _Block(TaskContext.get().partitionId() << 32, splitter)
        kind = None

        def listed() -> pa.RecordBatch:
            words = [w.encode() for w in block.words]
            slice_ = np.fromiter((zlib.crc32(w) % slices_ for w in words), np.int32, len(words))
            order = np.argsort(slice_, kind="stable")
            places, n_words = np.unique(slice_[order], return_counts=True)
            sizes = np.array([len(w) for w in words], np.int64)[order]
            flat = np.frombuffer(b"".join(words[i] for i in order.tolist()), np.uint8)
            n_bytes = np.add.reduceat(sizes, np.cumsum(n_words) - n_words) if len(words) else n_words
            raw, width = _varints(sizes)
            n_raw = np.add.reduceat(width, np.cumsum(n_words) - n_words) if len(words) else n_words
            n = len(places)
            back = np.concatenate([[-1], places]).astype(np.int32)
            # Numbers rise inside a slice; a smaller one begins the next slice.
            numbers, size = _varints(_steps(order))
            columns = [
                pa.array(np.full(n + 1, block.number)), pa.nulls(n + 1, kind), pa.array([numbers.tobytes()] + [None] * n, pa.binary()), pa.array(back),
                pa.concat_arrays([pa.nulls(1, pa.binary()), _cut(raw, n_raw)]), pa.concat_arrays([pa.nulls(1, pa.binary()), _cut(flat, n_bytes)]),
            ]
            return pa.RecordBatch.from_arrays(columns, names=_COLUMNS)

        for batch in batches:
            kind = batch.schema.field("row").type
            for part in slices(batch):
                size = int(pc.sum(pc.fill_null(pc.binary_length(part.column("text")), 0)).as_py() or 0)
                if block.bytes and block.bytes + size > block_bytes:
                    yield listed()
                    block = _Block(block.number + 1, splitter)
                block.bytes += size
                texts = part.column("text")
                raw, sizes = block.positions(texts.to_pylist())
                column = pc.if_else(pc.is_valid(texts), _cut(np.frombuffer(raw, np.uint8), sizes), pa.scalar(None, pa.binary()))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block.number)), part.column("row"), column, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                    names=_COLUMNS,
                )
        if kind is not None:
            yield listed()

    types = [LongType(), docs.schema["row"].dataType, BinaryType(), IntegerType(), BinaryType(), BinaryType()]
    schema = StructType([StructField(c, t) for c, t in zip(_COLUMNS, types, strict=True)])
    return docs.select("row", "text").mapInArrow(cut, schema)


_COLUMNS = ["block", "row", "positions", "slice", "sizes", "words"]


def _steps(order: np.ndarray) -> np.ndarray:
    """Rising runs of numbers as steps: twice the rise, or, where a run begins, twice the number plus one."""
    rise = np.diff(order, prepend=-1)
    return np.where(rise > 0, 2 * rise, 2 * order + 1)


def _from_steps(steps: np.ndarray) -> np.ndarray:
    """The numbers of ``_steps``."""
    begins = (steps & 1) == 1
    total = np.cumsum(np.where(begins, 0, steps >> 1))
    run = np.cumsum(begins)
    # Before the first beginning a run starts from -1.
    base = np.concatenate([[-1], (steps >> 1)[begins] - total[begins]])
    return total + base[run]


def _bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """``df`` written once in ``buckets`` parts by a column, so that it can be grouped without a shuffle."""
    spark = df.sparkSession
    name = scratch_tables(f"annalist_bpe_{uuid.uuid4().hex}")
    path = scratch_path(spark, "bpe-blocks")
    df.write.bucketBy(buckets, by).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def _encoded_words(words: DataFrame, vocabulary: Vocabulary, parts: int) -> DataFrame:
    """(block, slice, sizes, ids): ids of a block's words of a slice; ``words`` is (block, slice, sizes, words)."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        last = None
        for batch in batches:
            places = batch.column("slice").to_numpy()
            edges = np.flatnonzero(np.diff(places, prepend=-1, append=-1))
            for at, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if places[at] != last:
                    known, last = {}, places[at]  # rows come in order of slices
                lists = []
                for sizes, raw in zip(batch.column("sizes").slice(at, end - at).to_pylist(), batch.column("words").slice(at, end - at).to_pylist(), strict=True):
                    ends = np.cumsum(_numbers(np.frombuffer(sizes, np.uint8))[0]).tolist()
                    lists.append([raw[a:b] for a, b in zip([0, *ends], ends)])
                new = list(dict.fromkeys(w for ws in lists for w in ws if w not in known))
                known.update(zip(new, encode_words(new, vocabulary), strict=True))
                found = [[known[w] for w in ws] for ws in lists]
                counts = [np.array([len(x) for x in ids], np.int64) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block").slice(at, end - at), batch.column("slice").slice(at, end - at),
                        pa.array([_varints(n)[0].tobytes() for n in counts], pa.binary()),
                        pa.array([np.concatenate(ids).astype(vocabulary.id_type).tobytes() for ids in found], pa.binary()),
                    ],
                    names=["block", "slice", "sizes", "ids"],
                )

    dealt = words.repartition(parts, "slice").sortWithinPartitions("slice", "block")
    return dealt.mapInArrow(encoded, "block long, slice int, sizes binary, ids binary")


def _cut(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An array as byte strings of ``counts`` values each."""
    offsets = (np.concatenate([[0], np.cumsum(counts)]) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _joined(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """The columns of ``docs`` but text, with tokens (ids) and n_tokens; `decode_documents` gives the text back."""
    vocabulary = vocabulary or read_vocabulary()
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in docs.columns if c not in ("text", "tokens", "n_tokens")]
    packed = docs.select(F.struct(F.lit(True).alias("text"), *[F.col(c) for c in rest]).alias("row"), "text")
    blocks = _bucketed(_blocks(packed, vocabulary, block_bytes, SLICES * parts), "block", parts)
    ids = _encoded_words(blocks.where("slice >= 0").select("block", "slice", "sizes", "words"), vocabulary, parts)
    id_type = vocabulary.id_type

    def assembled(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("slice")
        listing = pc.equal(pc.fill_null(left["slice"], 0), -1)
        order = _from_steps(_numbers(_joined(left.filter(listing)["positions"], np.uint8))[0])
        left = left.filter(pc.invert(listing))
        sizes, flat = _numbers(_joined(right["sizes"], np.uint8))[0], _joined(right["ids"], id_type)
        starts, lengths = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        starts[order], lengths[order] = np.cumsum(sizes) - sizes, sizes
        positions = left["positions"].combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(positions), 0).to_numpy(zero_copy_only=False))])
        word, last = _numbers(np.frombuffer(b"".join(x or b"" for x in positions.to_pylist()), np.uint8))
        n_words = np.diff(np.searchsorted(last, bounds, "left"))
        of = lengths[word]
        tokens = flat[ragged(starts[word], of)].astype(np.int32)
        sums = np.concatenate([[0], np.cumsum(of)])
        ends = np.cumsum(n_words)
        n = sums[ends] - sums[ends - n_words]
        return pa.table({"row": left["row"], "tokens": _lists(tokens, n, pa.int32(), pc.is_null(positions)), "n_tokens": pa.array(n)})

    rows = blocks.where("slice IS NULL OR slice = -1").select("block", "row", "positions", "slice")
    schema = StructType([rows.schema["row"], StructField("tokens", ArrayType(IntegerType())), StructField("n_tokens", LongType())])
    done = rows.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(assembled, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in rest], "tokens", "n_tokens")


def token_bytes(tokens: pa.Array, vocabulary: Vocabulary) -> tuple[bytes, np.ndarray]:
    """The bytes of all token lists of a column, and how many bytes each list has (null: none)."""
    ids = tokens.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = vocabulary.lengths[ids]
    raw = vocabulary.blob[ragged(vocabulary.ends[ids] - lengths, lengths)].tobytes()
    sums, ends = np.concatenate([[0], np.cumsum(lengths)]), np.cumsum(n)
    return raw, sums[ends] - sums[ends - n]


#: Rows decoded at once.
ROWS = 256


def decode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``docs`` with text made from tokens; null where tokens are null. Bytes that are no UTF-8 are replaced."""
    vocabulary = vocabulary or read_vocabulary()
    rows = docs.drop("text")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                raw, sizes = token_bytes(part.column("tokens"), vocabulary)
                valid, end, texts = pc.is_valid(part.column("tokens")).to_pylist(), 0, []
                for there, size in zip(valid, sizes.tolist(), strict=True):
                    texts.append(raw[end : end + size].decode("utf-8", "replace") if there else None)
                    end += size
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    return rows.mapInArrow(decoded, StructType([*rows.schema.fields, StructField("text", StringType())]))


def digests(coded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids (unsigned 32 bits, little-endian) and of the decoded bytes."""
    vocabulary = vocabulary or read_vocabulary()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                tokens = part.column("tokens")
                raw, sizes = token_bytes(tokens, vocabulary)
                ids = tokens.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
                out, end, id_end = [], 0, 0
                for n, size in zip(pc.fill_null(pc.list_value_length(tokens), 0).to_pylist(), sizes.tolist(), strict=True):
                    out.append((hashlib.sha256(ids[id_end : id_end + 4 * n]).hexdigest(), hashlib.sha256(raw[end : end + size]).hexdigest()))
                    id_end, end = id_end + 4 * n, end + size
                columns = [pa.array([x[k] for x in out], pa.string()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_tokens"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = coded.select("doc_id", "n_tokens", "tokens")
    schema = StructType([rows.schema["doc_id"], rows.schema["n_tokens"], *(StructField(c, StringType()) for c in ("ids_sha256", "decoded_sha256"))])
    return rows.mapInArrow(hashed, schema)


def byte_tokens(docs: DataFrame) -> DataFrame:
    """The registered query."""
    vocabulary = read_vocabulary()
    return digests(encode_documents(docs.select("doc_id", "text"), vocabulary), vocabulary)
