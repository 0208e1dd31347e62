import hashlib
import random

from annalist.llm import winnowing
from tests.llm.plain import WORD


def plain(text):
    """Choices of a text as (hash, position), straight from the definition."""
    x = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in WORD.findall(text)]

    def fold(part):
        h = 0
        for v in part:
            h = (h * winnowing.BASE + v) % winnowing.PRIME
        return h

    k, w = winnowing.GRAM, winnowing.WINDOW
    h = [fold(x[i : i + k]) for i in range(len(x) - k + 1)] if len(x) >= k else [fold(x)] if x else []
    out = set()
    for a in range(max(1, len(h) - w + 1) if h else 0):
        part = h[a : a + w]
        at = max(i for i, v in enumerate(part) if v == min(part))
        out.add((a + at, part[at]))
    return [(v, at) for at, v in sorted(out)]


def written(choices):
    return ",".join(f"{v:x}@{at}" for v, at in choices)


def alike(a, b):
    a, b = ({v for v, _ in x} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """Rows of (doc_id, text) with distinct ids."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, new = plain(t), plain(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(new), round(alike(own, new), 9), round(alike(own, plain(after)), 9)))
    return sorted(out, key=str)


def answer(df):
    rows = [tuple(r) for r in winnowing.fingerprints(df).collect()]
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=str)


def test_awkward_rows(spark, odd, none):
    seen, rows = set(), []
    for r in odd.collect():
        if r.doc_id not in seen:
            seen.add(r.doc_id)
            rows.append((r.doc_id, r.text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(df) == expected(rows)
    assert winnowing.fingerprints(none).collect() == []
    assert winnowing.fingerprints(odd).count() == odd.count()


def test_ranges_of_ids_join_up(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.randrange(10**12), " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(60)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def derive(d):
        return d

    out = winnowing.with_next(df, derive, ["text"], part_rows=20).select("doc_id", "next_text").collect()
    rows.sort(reverse=True)
    assert sorted(map(tuple, out)) == sorted((rows[i][0], rows[(i + 1) % len(rows)][1]) for i in range(len(rows)))


def test_shared_passage_shares_a_choice(spark):
    rng = random.Random(9)

    def words(n):
        return [f"v{rng.randrange(10**6)}" for _ in range(n)]

    rows = []
    for i in range(40):
        passage = words(winnowing.GRAM + winnowing.WINDOW - 1)
        a, b = (" ".join(words(rng.randrange(30)) + passage + words(rng.randrange(30))) for _ in range(2))
        rows.append((i, a, b))
    df = spark.createDataFrame(rows, "doc_id long, a string, b string")
    df = winnowing.with_choices(winnowing.with_choices(df, "a", "ca"), "b", "cb")
    for r in df.select("a", "b", winnowing.shared_runs("ca", "cb").alias("runs")).collect():
        a, b = r.a.split(), r.b.split()
        assert r.runs and all(a[x.at : x.at + winnowing.GRAM] == b[x.other : x.other + winnowing.GRAM] for x in r.runs)
