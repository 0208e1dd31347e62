"""Personal data: exact patterns, and a skip-chain conditional random field that adds to them.

The patterns (`base_spans`) find e-mail addresses, IP addresses, payment cards and phone numbers.
The field labels words. A node is a word with a digit or an ``@``, a word that is the part before the
``@`` of an address of its document, or a neighbour of one; any other word is O. Neighbouring nodes are linked, and so are distant words of one document that are equal or
similar (same digits whatever stands between them; an address and its part before the ``@``), each
with the next of its kind, so a document has no more skip links than words; keys of fewer than ``KEY``
characters say too little and link nothing. Loopy message passing
over both kinds of links, until the messages of a document stand still, makes the labels of repeated words agree: a bare number that stands
elsewhere in full is marked here, too.

A word is described by its shape - letters, punctuation and how many digits stand where - and by what
the tests of the kinds say about its digits: whether 13 to 19 of them pass Luhn, whether four numbers
are octets. The description is hashed to one of ``SHAPES`` entries; nothing of a word is cut off.

Training is piecewise and needs no sample: the patterns label the words of all documents, and the
potentials are smoothed log ratios of counts - of a word's shape with its label, of labels side by
side, of labels across a skip link. A word that repeats one a pattern labels elsewhere in the document
counts with that label, so a missed repetition does not teach that repetitions differ; where the
kind's own test refuses the word, it counts as O, and where it repeats words of several labels it is
not counted. Counts are summed per batch and then by Spark.

Words inside pattern spans are held at their label. Another word gets a span when a label other than O
has at least ``SURE`` probability, the word repeats one that is held at this label (`Graph.likely`), the
kind's own test does not refuse its digits, and no pattern span of that kind is touched.

A null text is an empty one and has no spans. Repeated rows are labelled alike, each by itself. Work
on a text is linear in its length for each round of messages; rounds go on while a message changes by
``STILL`` or more, for four times the nodes of the document at most, as messages in loops may swing; a
document that still moves then says so (``settled``). Ties between labels go to the first of ``LABELS``.
Null and repeated ids are carried along; an empty table gives an empty result; columns other than
doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.texts import slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
#: Entries of the table of shapes; rare shapes that meet in one share it.
SHAPES = 1 << 16
SURE = 0.9
#: Rounds between two looks at which documents stand still.
ROUNDS = 12
#: Largest change of a log message that counts as none.
STILL = 1e-3
DAMPING = 0.5
KEY = 4
HELD = 8.0

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all pattern matches, by kind, then start; code points, end exclusive."""
    found = (_emails(text), _ips(text), _cards(text), _phones(text))
    return [(k, a, b) for k, spans in enumerate(found) for a, b in spans]


def _run(m: re.Match) -> str:
    run = m.group()
    if not run[0].isdigit():
        return "a"
    n = len(run)
    return "3" if n < 4 else "4" if n == 4 else "8" if n < 9 else "c" if n < 13 else "k" if n < 20 else "z"


_GROUPS = re.compile(r"[0-9]+")


def refused(kind: int, word: str) -> bool:
    """Whether the test of a kind of number refuses the digits of a word."""
    digits = _NOT_DIGIT.sub("", word)
    if KINDS[kind] == "ip":
        groups = [g.lstrip("0") for g in _GROUPS.findall(word)]
        return len(groups) != 4 or any(len(g) > 3 or int(g or 0) > 255 for g in groups)
    if KINDS[kind] == "card":
        return not 13 <= len(digits) <= 19 or not passes_luhn(digits)
    if KINDS[kind] == "phone":
        return not 7 <= len(digits) <= 15
    return False


def shape(word: str) -> str:
    """An entry of the table: letters are one a, digits a mark of how many, and what the tests say; punctuation
    stays, but not at the end."""
    word = word.rstrip(".,;:!?")
    verdict = "".join("-" if refused(k, word) else "+" for k in (1, 2, 3)) if _MARK.search(word) else ""
    return str(xxhash.xxh3_64_intdigest(f"{_RUNS.sub(_run, word)} {verdict}") % SHAPES)


def likeness_key(word: str) -> str:
    """Words with the same key count as repeated."""
    word = word.lower().strip("()[]<>{}\"'.,;:!?")
    if "@" in word:
        return word.partition("@")[0]
    digits = _NOT_DIGIT.sub("", word)
    return digits if len(digits) >= 4 and not re.search("[a-z]", word) else word


class Graph:
    """The nodes and links of one document: word spans, shapes, labels held by patterns (or 0)."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]) -> None:
        words = [m.span() for m in _WORD.finditer(text)]
        marked = [i for i, (a, b) in enumerate(words) if _MARK.search(text, a, b)]
        before = {likeness_key(text[a:b]) for a, b in (words[i] for i in marked) if "@" in text[a:b]}
        before = {k for k in before if len(k) >= KEY and not _MARK.search(k)}
        if before:
            marked = sorted({*marked, *(i for i, (a, b) in enumerate(words) if likeness_key(text[a:b]) in before)})
        places = sorted({j for i in marked for j in (i - 1, i, i + 1) if 0 <= j < len(words)})
        self.spans = [words[i] for i in places]
        words_at = [text[a:b] for a, b in self.spans]
        self.shapes = [shape(w) for w in words_at]
        self.held = [0] * len(places)
        by_start = sorted((a, b, k + 1) for k, a, b in spans)
        begin = 0
        for n, (a, b) in enumerate(self.spans):
            while begin < len(by_start) and by_start[begin][1] <= a:
                begin += 1
            at = begin
            while at < len(by_start) and by_start[at][0] < b and not self.held[n]:
                self.held[n] = by_start[at][2] if by_start[at][1] > a else 0
                at += 1
        self.chain = [(n, n + 1) for n in range(len(places) - 1) if places[n + 1] == places[n] + 1]
        marked_at = set(marked)
        self.marked = [i in marked_at for i in places]
        keys = [likeness_key(w) if m else "" for w, m in zip(words_at, self.marked, strict=True)]
        names = [[k] if len(k) >= KEY else [] for k in keys]
        # A number of several words can be repeated as one: its digits name its first word, too.
        node_at = {a: n for n, (a, _) in enumerate(self.spans)}
        labelled: list[set[str]] = [set() for _ in LABELS]
        for k, a, b in spans:
            digits = _NOT_DIGIT.sub("", text[a:b])
            if KINDS[k] in ("card", "phone") and a in node_at:
                whole = {digits, digits[-10:]} if KINDS[k] == "phone" and len(digits) > 10 else {digits}
                names[node_at[a]] += sorted(whole.difference(names[node_at[a]]))
        for held, known in zip(self.held, names, strict=True):
            labelled[held].update(known)
        #: Labels of held words that a word repeats and whose test does not refuse it.
        self.likely = [
            frozenset(x for x in range(1, len(LABELS)) if not held and key in labelled[x] and not refused(x - 1, word))
            for held, key, word in zip(self.held, keys, words_at, strict=True)
        ]
        #: Labels for training: that of the pattern, or of the one kind whose held word is repeated; None if of several.
        self.taught = [held or (0 if not x else next(iter(x)) if len(x) == 1 else None) for held, x in zip(self.held, self.likely, strict=True)]
        self.settled = True
        last: dict[str, int] = {}
        linked = set()
        for n, known in enumerate(names):
            for key in known:
                if key in last:
                    linked.add((last[key], n))
                last[key] = n
        self.skip = sorted(linked)


def count(texts: list[str | None]) -> Counter:
    """Counts for training: ("e", shape, label), ("c", label, label), ("s", label, label)."""
    out: Counter = Counter()
    for text in texts:
        if not text:
            continue
        g = Graph(text, base_spans(text))
        out.update(("e", s, str(k)) for s, k in zip(g.shapes, g.taught, strict=True) if k is not None)
        for kind, links in (("c", g.chain), ("s", g.skip)):
            out.update((kind, str(g.taught[a]), str(g.taught[b])) for a, b in links if g.taught[a] is not None and g.taught[b] is not None)
    return out


class Model:
    """Potentials of the field: log p(label | shape), and log ratios for the two kinds of links."""

    def __init__(self, shapes: dict[str, np.ndarray], chain: np.ndarray, skip: np.ndarray) -> None:
        prior = sum(shapes.values(), np.zeros(len(LABELS))) + 1
        prior /= prior.sum()
        self.rare = np.log(prior)
        self.shapes = {s: np.log((n + prior) / (n.sum() + 1)) for s, n in shapes.items()}
        self.chain, self.skip = self._ratios(chain), self._ratios(skip)

    @staticmethod
    def _ratios(counts: np.ndarray) -> np.ndarray:
        counts = counts + counts.T + 1.0  # links have no direction
        p = counts / counts.sum()
        return np.log(p / np.outer(p.sum(1), p.sum(0)))

    def marginals(self, graphs: list[Graph]) -> np.ndarray:
        """Label probabilities of all nodes of all graphs, by loopy message passing."""
        start = np.cumsum([0, *(len(g.spans) for g in graphs)])
        nodes = np.array([self.shapes.get(s, self.rare) for g in graphs for s in g.shapes]).reshape(-1, len(LABELS))
        held = np.array([k for g in graphs for k in g.held], dtype=int)
        at = np.flatnonzero(held)
        nodes[at, held[at]] += HELD
        links = [(a + s, b + s, kind) for g, s in zip(graphs, start, strict=False) for kind, of in enumerate((g.chain, g.skip)) for a, b in of]
        if not links:
            return _normal(nodes)
        a, b, kind = np.array(links).T
        of = np.searchsorted(start, a, side="right") - 1
        messages = np.zeros((2 * len(a), len(LABELS)))
        belief, rounds = nodes.copy(), 0
        while len(a):
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            potential = np.stack([self.chain, self.skip])[np.concatenate([kind, kind])]
            order = np.argsort(target, kind="stable")
            into, first = np.unique(target[order], return_index=True)
            for _ in range(ROUNDS):
                sent = belief[source] - messages[back]
                new = np.logaddexp.reduce(sent[:, :, None] + potential, axis=1)
                new -= np.logaddexp.reduce(new, axis=1)[:, None]
                change = np.abs(new - messages).max(axis=1)
                messages = DAMPING * messages + (1 - DAMPING) * new
                belief[into] = nodes[into] + np.add.reduceat(messages[order], first, axis=0)
            rounds += ROUNDS
            moving = np.zeros(len(graphs), bool)
            moving[np.concatenate([of, of])[change >= STILL]] = True
            over = moving & (rounds >= 4 * np.diff(start))
            for i in np.flatnonzero(over):
                graphs[i].settled = False
            moving &= ~over
            keep = moving[of]
            a, b, kind, of, messages = a[keep], b[keep], kind[keep], of[keep], messages[np.concatenate([keep, keep])]
        return _normal(belief)


def _normal(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - np.logaddexp.reduce(scores, axis=1)[:, None]) if len(scores) else scores


def added_spans(graph: Graph, p: np.ndarray, base: list[tuple[int, int, int]], text: str) -> list[tuple[int, int, int]]:
    """Spans of words that the field labels and no pattern span of that kind touches."""
    out: list[tuple[int, int, int]] = []
    best = p.argmax(1)
    neighbours = {b for _, b in graph.chain}
    open_span = None
    for n, (a, b) in enumerate(graph.spans):
        label = int(best[n])
        if label in graph.likely[n] and p[n, label] >= SURE and graph.marked[n]:
            while b > a and text[b - 1] in ".,;:!?":
                b -= 1
            if open_span and n in neighbours and open_span[0] == label - 1:
                open_span[2] = b
            else:
                open_span = [label - 1, a, b]
                out.append(open_span)
        else:
            open_span = None
    ends = [[b for k, _, b in base if k == kind] for kind in range(len(KINDS))]
    starts = [[a for k, a, _ in base if k == kind] for kind in range(len(KINDS))]

    def free(k: int, a: int, b: int) -> bool:
        i = bisect_right(ends[k], a)  # the first pattern span that ends behind a
        return i == len(ends[k]) or starts[k][i] >= b

    return [(k, a, b) for k, a, b in out if b > a and free(k, a, b)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def label(texts: list[str | None], model: Model) -> list[tuple[list, list, bool]]:
    """For each text its pattern spans, the spans the field adds, and whether its messages stood still."""
    bases = [base_spans(t) if t else [] for t in texts]
    graphs = [Graph(t, b) if t else None for t, b in zip(texts, bases, strict=True)]
    p = model.marginals([g for g in graphs if g])
    out, at = [], 0
    for text, base, g in zip(texts, bases, graphs, strict=True):
        n = len(g.spans) if g else 0
        out.append((base, added_spans(g, p[at : at + n], base, text) if n else [], g is None or g.settled))
        at += n
    return out


def _marked_texts(docs: DataFrame) -> DataFrame:
    """Texts without digit and ``@`` have no spans and need not leave the JVM."""
    return docs.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))


#: Texts handed to numpy at once.
GROUP = 256


def train(docs: DataFrame) -> Model:
    """Fit the potentials on all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                total.update(count(part.column("text").to_pylist()))
        rows = [(*k, n) for k, n in total.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in range(3)] + [pa.array([r[3] for r in rows], pa.int64())],
            names=["part", "a", "b", "n"],
        )

    texts = _marked_texts(docs).where("text IS NOT NULL").select("text")
    counts = texts.mapInArrow(counted, "part string, a string, b string, n long").groupBy("part", "a", "b").agg(F.sum("n").alias("n"))
    by_shape = counts.where("part = 'e'").groupBy("a").agg(
        *[F.sum(F.when(F.col("b") == str(k), F.col("n"))).alias(f"n{k}") for k in range(len(LABELS))]
    )
    shapes = {r["a"]: np.array([r[f"n{k}"] or 0 for k in range(len(LABELS))], dtype=float) for r in by_shape.collect()}
    links = {"c": np.zeros((len(LABELS), len(LABELS))), "s": np.zeros((len(LABELS), len(LABELS)))}
    for r in counts.where("part <> 'e'").collect():
        links[r["part"]][int(r["a"]), int(r["b"])] += r["n"]
    return Model(shapes, links["c"], links["s"])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, settled boolean"


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, counts by kind, base_sha256 over the pattern spans, all spans, n_added, settled."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = model or train(docs)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                labelled = label(part.column("text").to_pylist(), model)
                counts = [[sum(k == kind for k, _, _ in base) for base, _, _ in labelled] for kind in range(len(KINDS))]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _, _ in labelled]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                     pa.array([written(base + more) for base, more, _ in labelled], pa.string()),
                     pa.array([len(more) for _, more, _ in labelled], pa.int64()), pa.array([still for _, _, still in labelled], pa.bool_())],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "settled"],
                )

    return _marked_texts(docs).mapInArrow(found, SCHEMA)
