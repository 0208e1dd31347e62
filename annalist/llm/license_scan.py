"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Words are runs of ASCII letters and digits, lower-cased. Of each template the hashes of ``GRAM`` words in
a row are winnowed and put into an inverted index. Window and threshold follow from the coverage that
counts: where at most a share of ``1 - COVERAGE`` of a template's words is replaced or left out, some run
of `sure_run` words is untouched, so a window that long keeps a fingerprint of it; and an edit destroys
``GRAM`` fingerprints at most, so at least `hits_needed` are left. A document looks up all its runs. As
many hits of a template on about the same diagonal are a candidate, and the words around it are
aligned with the template: local alignment in a band as wide as the hits lie apart, and a quarter of the
template's length to either side. All diagonals of a template stay open, so copies may interleave. A
finding is reported when the aligned words cover at least ``COVERAGE`` of the template (being local, an
alignment may stop before words that match behind more edits than they are worth); of findings of
one template that overlap, the one of higher coverage, then the earlier, stays.

The index is a few templates large and is sent to every task; texts stay where they are, whole. A
null or empty text has no findings, an empty table none. Repeated rows have equal findings; null and
repeated ids are carried along. Work on a text is linear in its words and hits, so very long texts are
like many short ones. Columns other than doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.templates import NOTICES
from annalist.llm.texts import slices

GRAM = 2
#: Words of a template at least; fewer say too little.
LEAST = 3
COVERAGE = 0.7
MATCH, OTHER, GAP = 2, -1, -1
_WORD = re.compile(rb"[a-z0-9]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def band_of(template: np.ndarray) -> int:
    """Narrow for short templates, so that copies that follow one another stay apart."""
    return max(2, len(template) // 4)


def edits_allowed(m: int) -> int:
    """Words of ``m`` that a finding may lack."""
    return m - math.ceil(COVERAGE * m)


def sure_run(m: int) -> int:
    """Words in a row that some part of a finding has untouched."""
    e = edits_allowed(m)
    return -(-(m - e) // (e + 1))


def hits_needed(m: int, kept: int) -> int:
    """Fingerprints, of the ``kept`` ones of a template, that a finding has at least."""
    return max(1, kept - GRAM * edits_allowed(m))


def _stir(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def runs(ids: np.ndarray) -> np.ndarray:
    """One number for each GRAM word numbers in a row; 0 where a word is not of any template."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out, known = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(GRAM):
        part = ids[i : n + i]
        out = (out << 20) | part
        known &= part > 0
    return np.where(known, out, 0)


def winnowed(values: np.ndarray, window: int) -> list[int]:
    """Places of the least hash of each window, the rightmost on ties."""
    hashes = _stir(values)
    chosen = set()
    for a in range(max(1, len(hashes) - window + 1)):
        part = hashes[a : a + window]
        chosen.add(a + len(part) - 1 - int(part[::-1].argmin()))
    return sorted(chosen)


class Index:
    """Templates as word numbers, and where their fingerprints stand."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = list(templates)
        self.numbers: dict[bytes, int] = {}
        self.words = []
        self.needed: list[int] = []
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, text in enumerate(templates.values()):
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text.encode())], np.int64)
            if len(ids) < LEAST:
                raise ValueError(f"template {self.names[t]} has fewer than {LEAST} words")
            self.words.append(ids)
            values = runs(ids)
            kept = winnowed(values, max(1, sure_run(len(ids)) - GRAM + 1))
            self.needed.append(hits_needed(len(ids), len(kept)))
            for at in kept:
                postings[int(values[at])].append((t, at))
        if len(self.numbers) >= 1 << 20:
            raise ValueError("templates have too many distinct words")
        self.keys = np.array(sorted(postings), np.int64)
        self.postings = [postings[k] for k in self.keys.tolist()]

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, diagonal, half the spread of the hits): enough hits on about one diagonal."""
        values = runs(ids)
        at = np.flatnonzero(values)
        if not len(at):
            return []
        slot = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        hit = self.keys[slot] == values[at]
        diagonals: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for place, key in zip(at[hit].tolist(), slot[hit].tolist(), strict=True):
            for t, template_at in self.postings[key]:
                diagonals[t].append((place - template_at, template_at))
        return [(t, *c) for t, hits in diagonals.items() if len(hits) >= self.needed[t] for c in self._crowded(t, hits)]

    def _crowded(self, t: int, hits: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Middle and half width of the stretches of diagonals with enough different fingerprints.

        Stretches are as wide as the band and overlap by half, so hits that lie closer together than
        half a band are whole in one of them.
        """
        wide, needed = band_of(self.words[t]), self.needed[t]
        hits = sorted(hits)
        count: dict[int, int] = defaultdict(int)
        end = begin = 0
        while begin < len(hits):
            first = hits[begin][0]
            while end < len(hits) and hits[end][0] <= first + wide:
                count[hits[end][1]] += 1
                end += 1
            stop = begin + 1
            if len(count) >= needed:
                last = hits[end - 1][0]
                yield (first + last) // 2, -(-(last - first) // 2)
                while stop < len(hits) and hits[stop][0] <= first + wide // 2:
                    stop += 1
            for _, template_at in hits[begin : min(stop, end)]:
                count[template_at] -= 1
                if not count[template_at]:
                    del count[template_at]
            begin = stop
            end = max(end, begin)


def align(template: np.ndarray, words: np.ndarray, diagonal: int, spread: int = 0) -> tuple[int, int, int, int, int]:
    """Best local alignment within the band: (matches, template from, to, words from, to); ends exclusive."""
    m, band = len(template), band_of(template) + spread
    width = 2 * band + 1
    score = np.zeros((m + 1, width + 2), np.int32)
    across = np.arange(width, dtype=np.int32) * -GAP
    place = np.arange(width) - band + diagonal
    # The words that any row of the band meets, -1 beyond the ends; row i sees ``width`` of them from i - 1 on.
    first = diagonal - band
    met = np.full(m - 1 + width, -1, np.int64)
    a, b = max(0, first), min(len(words), first + len(met))
    if a < b:
        met[a - first : b - first] = words[a:b]
    gain = np.where(sliding_window_view(met, width) == template[:, None], np.int32(MATCH), np.int32(OTHER))
    outside = sliding_window_view(met < 0, width)
    cut = a - first > 0 or b - first < len(met)
    for i in range(1, m + 1):
        # In band coordinates the diagonal step keeps the column, and the step down comes from the right.
        best = np.maximum(score[i - 1, 1:-1] + gain[i - 1], score[i - 1, 2:] + GAP)
        np.maximum(best, 0, out=best)
        if cut:
            best[outside[i - 1]] = 0
        along = np.maximum.accumulate(best + across) - across
        if cut:
            along[outside[i - 1]] = 0
        score[i, 1:-1] = along
    i, c = divmod(int(score[:, 1:-1].argmax()), width)
    to_i, to_j, matches = i, int(place[c]) + i, 0
    from_i, from_j = to_i, to_j
    while i > 0 and score[i, c + 1] > 0:
        j = int(place[c]) + i - 1
        here = score[i, c + 1]
        same = 0 <= j < len(words) and words[j] == template[i - 1]
        if here == score[i - 1, c + 1] + (MATCH if same else OTHER):
            matches += int(same)
            i -= 1
            from_i, from_j = i, j
        elif here == score[i - 1, c + 2] + GAP:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return matches, from_i, to_i, from_j, to_j


def scan(text: bytes | None, index: Index) -> list[tuple[str, float, int, int, int, int, int]]:
    """(template, coverage, matched words, first word, end word, start, end) of each finding."""
    words = words_of(text or b"")
    ids = np.fromiter((index.numbers.get(w, 0) for w in words), np.int64, len(words))
    best: dict[int, list[tuple[float, int, int, int]]] = defaultdict(list)
    for t, diagonal, spread in index.candidates(ids):
        template = index.words[t]
        beyond = band_of(template) + spread + 1
        low = max(0, diagonal - beyond)
        part = ids[low : max(0, diagonal + len(template) + beyond)]
        matches, _, _, a, b = align(template, part, diagonal - low, spread)
        if matches >= COVERAGE * len(template):
            best[t].append((-matches / len(template), a + low, b + low, matches))
    kept = []
    for t, found in best.items():
        kept += [(index.names[t], -coverage, matches, a, b) for coverage, a, b, matches in _apart(sorted(found))]
    if not kept:
        return []
    spans = [m.span() for m in _WORD.finditer(text.lower())]
    ascii_only = text.isascii()
    place = (lambda x: x) if ascii_only else (lambda x: len(text[:x].decode("utf-8", "replace")))
    return [(name, c, n, a, b, place(spans[a][0]), place(spans[b - 1][1])) for name, c, n, a, b in sorted(kept, key=lambda k: (k[3], k[0]))]


def _apart(found: list[tuple[float, int, int, int]]) -> Iterator[tuple[float, int, int, int]]:
    """Findings in order of quality, without those that overlap a better one."""
    taken: list[tuple[int, int]] = []
    for f in found:
        at = bisect_left(taken, (f[1], f[2]))
        if (at == 0 or taken[at - 1][1] <= f[1]) and (at == len(taken) or taken[at][0] >= f[2]):
            insort(taken, (f[1], f[2]))
            yield f


SCHEMA = "doc_id long, template string, coverage double, matched_words int, word_start int, word_end int, start int, end int"


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per finding: doc_id, template, coverage, matched words, word span, span in code points."""
    index = Index(templates or NOTICES)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, *f)
                for part in slices(batch)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)
                for f in scan(text, index)
            ]
            kinds = (pa.int64(), pa.string(), pa.float64(), *[pa.int32()] * 5)
            names = ["doc_id", "template", "coverage", "matched_words", "word_start", "word_end", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(found, SCHEMA)
