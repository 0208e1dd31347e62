import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import pii

NAIVE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"),
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    """The patterns as they are written, failing matches dropped."""
    out = []
    for kind, pattern in enumerate(NAIVE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.passes_luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"a1.@+- ()9é%", "4012888888881881", "10.0.0.1", "+1 (308) 555-0351", "b@c.d"]), max_size=40))
def test_patterns_equal_the_written_ones(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_luhn():
    assert pii.passes_luhn("4012888888881881") and not pii.passes_luhn("4012888888881882")


def test_long_runs_are_linear():
    for text in ("a" * 400_000, "1" * 400_000, "@a" * 100_000, "+1 " * 100_000, "1.1.1" * 80_000):
        pii.base_spans(text)


def test_awkward_rows(odd, none):
    got = {r.doc_id: r for r in pii.find_personal_data(odd).collect()}
    texts = {r.doc_id: r.text for r in odd.collect()}
    for doc_id, r in got.items():
        base = plain_spans(texts[doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in range(4)]
        assert set(filter(None, pii.written(base).split(","))) <= set(r.spans.split(","))
    assert got[17].n_email == got[17].n_ip == got[17].n_card == got[17].n_phone == 1
    assert pii.find_personal_data(none).collect() == []


def test_the_field_carries_labels_to_repeated_words(spark):
    """A number that stands in full elsewhere is found where the pattern misses it; other numbers are left."""
    rows = []
    for i in range(60):
        number = f"555-{1000 + 37 * i}"
        rows.append((i, f"call +1 (308) {number} now. in {1900 + i} we had 12 cats. later {number} again"))
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    found = 0
    for r in out:
        spans = [x.split(":") for x in r.spans.split(",")]
        words = [texts[r.doc_id][int(a) : int(b)] for _, a, b in spans]
        assert not any(w.startswith(("19", "12")) for w in words)
        found += sum(w.startswith("555-") for w in words)
    assert found >= 54


def test_labels_reach_every_repeat():
    """A number that a pattern holds once and that stands bare many times: all of a chain of weak links is reached."""
    import numpy as np

    k = len(pii.LABELS)
    for repeats in (9, 19, 40):
        text = "+1 (308) 555-0351 " + " ".join(["so we say that 555-0351 it is"] * repeats)
        graph = pii.Graph(text, pii.base_spans(text))
        chain, skip = np.full((k, k), 5.0), np.full((k, k), 0.2) + np.diag([40_000.0] * k)
        even = np.array([1.0, 1, 1, 1, 1.02])
        p = pii.Model({s: even * 1e6 for s in set(graph.shapes)}, chain, skip).marginals([graph])
        bare = [n for n, (a, b) in enumerate(graph.spans) if text[a:b] == "555-0351" and not graph.held[n]]
        assert len(bare) == repeats and (p[bare].argmax(1) == 4).all() and (p[bare, 4] >= pii.SURE).all()


def test_an_address_is_linked_to_its_part_before_the_at():
    """Also where that part has no digit; the field can label it, and leaves the words around it alone."""
    import numpy as np

    text = "write to jane.doe@x.org today or ask for jane.doe, please"
    base = pii.base_spans(text)
    graph = pii.Graph(text, base)
    words = [text[a:b] for a, b in graph.spans]
    assert graph.skip == [(words.index("jane.doe@x.org"), words.index("jane.doe,"))]
    p = np.full((len(words), len(pii.LABELS)), 0.01)
    p[:, 1] = 0.96
    at = text.index("jane.doe,")
    assert pii.added_spans(graph, p, base, text) == [(0, at, at + len("jane.doe"))]


def test_messages_agree_with_sums_over_all_labellings():
    """On a graph without loops message passing is exact."""
    import itertools

    import numpy as np

    text = "+1 (308) 555-0351 and 12"
    graph = pii.Graph(text, [])
    rng = np.random.default_rng(0)
    k = len(pii.LABELS)
    model = pii.Model({s: rng.uniform(1, 9, k) for s in set(graph.shapes)}, rng.uniform(0, 9, (k, k)), rng.uniform(0, 9, (k, k)))
    got = model.marginals([graph])
    n = len(graph.spans)
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        score = sum(model.shapes[s][x] for s, x in zip(graph.shapes, labels, strict=True))
        score += sum(model.chain[labels[a], labels[b]] for a, b in graph.chain) + sum(model.skip[labels[a], labels[b]] for a, b in graph.skip)
        for i, x in enumerate(labels):
            total[i, x] += np.exp(score)
    assert not graph.skip and np.allclose(got, total / total.sum(1)[:, None], atol=2e-2)


def test_messages_with_skip_links_are_near_the_sums_over_all_labellings():
    """With loops message passing is an approximation: close to the exact sums, and of one mind on sure labels."""
    import itertools

    import numpy as np

    k = len(pii.LABELS)
    text = "+1 (308) 555-0351 x 555-0351 y 555-0351"
    for seed in range(25):
        graph = pii.Graph(text, pii.base_spans(text) if seed % 2 else [])
        assert len(graph.skip) == 2 and len(graph.chain) >= 5  # loops
        rng = np.random.default_rng(seed)
        counts = rng.uniform(5, 9, (k, k)) + np.diag(rng.uniform(0, 12, k))
        model = pii.Model({s: rng.uniform(1, 9, k) for s in set(graph.shapes)}, rng.uniform(4, 9, (k, k)), counts)
        got = model.marginals([graph])
        n = len(graph.spans)
        free = [[graph.held[i]] if graph.held[i] else range(k) for i in range(n)]
        total = np.zeros((n, k))
        for labels in itertools.product(*free):
            score = sum(model.shapes[s][x] for s, x in zip(graph.shapes, labels, strict=True))
            score += sum(model.chain[labels[a], labels[b]] for a, b in graph.chain) + sum(model.skip[labels[a], labels[b]] for a, b in graph.skip)
            for i, x in enumerate(labels):
                total[i, x] += np.exp(score)
        exact = total / total.sum(1)[:, None]
        bare = [i for i in range(n) if not graph.held[i]]
        assert graph.settled and np.abs(got[bare] - exact[bare]).max() < 0.06
        sure = [i for i in bare if exact[i].max() > 0.6]
        assert (got[sure].argmax(1) == exact[sure].argmax(1)).all()


def card(rng):
    digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(digits + str(x) for x in range(10) if pii.passes_luhn(digits + str(x)))


def test_precision_and_recall_on_planted_repeats(spark):
    """Repeats that the patterns miss are found; numbers that a test refuses, or that repeat nothing, are left."""
    import random

    rng = random.Random(11)
    rows, planted = [], set()
    for i in range(600):
        words = [rng.choice(["we", "say", "that", "the", "order", "was", "sent", "on", "time"]) for _ in range(12)]
        number, ip = f"555-{rng.randrange(1000, 9999)}", [str(rng.randrange(10, 255)) for _ in range(4)]
        paid, name = card(rng), rng.choice("abcdefgh") * 2 + str(rng.randrange(100, 999))
        shown, bare = rng.choice(
            [(f"+1 (308) {number}", number), (".".join(ip), "-".join(ip)), (paid, ".".join(paid[j : j + 4] for j in (0, 4, 8, 12))), (f"{name}@mail.example", name)]
        )
        wrong = paid[:-1] + str((int(paid[-1]) + 1) % 10)
        text = " ".join([*words[:4], shown, *words[4:7], wrong, *words[7:9], str(rng.randrange(1900, 2020)), wrong, *words[9:], bare, "again", f"{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"])
        planted.add((i, text.rindex(f" {bare} again") + 1))
        rows.append((i, text))
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts, added = dict(rows), set()
    for r in out:
        base = set(pii.written(pii.base_spans(texts[r.doc_id])).split(","))
        added |= {(r.doc_id, int(x.split(":")[1])) for x in r.spans.split(",") if x not in base}
        assert r.settled and r.n_added == len(set(r.spans.split(",")) - base)
    hits = len(added & planted)
    assert hits >= 0.9 * len(planted) and hits >= 0.9 * len(added)
