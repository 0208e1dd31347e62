import random

import numpy as np
import pytest

from annalist.llm import license_scan
from annalist.llm.tables import documents
from annalist.llm.templates import NOTICES

INDEX = license_scan.Index(NOTICES)


def whole_alignment(template, words):
    """Best score of a local alignment, without band."""
    score = np.zeros((len(template) + 1, len(words) + 1))
    for i in range(1, len(template) + 1):
        for j in range(1, len(words) + 1):
            same = template[i - 1] == words[j - 1]
            step = license_scan.MATCH if same else license_scan.OTHER
            score[i, j] = max(0, score[i - 1, j - 1] + step, score[i - 1, j] + license_scan.GAP, score[i, j - 1] + license_scan.GAP)
    return score.max()


def test_every_notice_is_found_whole():
    for name, notice in NOTICES.items():
        text = f"Some wörds before. {notice} And some after."
        found = {f[0]: f for f in license_scan.scan(text.encode(), INDEX)}
        _, coverage, matched, a, b, start, end = found[name]
        assert coverage == 1 and matched == b - a == len(license_scan.words_of(notice.encode()))
        assert text[start:end] == notice.rstrip('."/')


def test_edited_notices_are_measured():
    rng = random.Random(2)
    for name in ("MIT-text", "Apache-2.0-header", "GPL-3.0-header", "BSD-text"):
        for _ in range(10):
            words = NOTICES[name].split()
            for _ in range(4):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
            found = {f[0]: f for f in license_scan.scan(("x " * 30 + " ".join(words)).encode(), INDEX)}
            assert found[name][1] >= 0.85


def test_band_is_wide_enough_for_the_best_alignment():
    rng = random.Random(3)
    for t, template in enumerate(INDEX.words[:4] + INDEX.words[6:8]):
        for _ in range(5):
            words = template.tolist()
            for _ in range(len(words) // 10):
                words.insert(rng.randrange(len(words)), 0)
            words = np.array([0] * 5 + words + [0] * 5)
            matches, a, b, c, d = license_scan.align(template, words, 5)
            aligned = matches * license_scan.MATCH - (b - a - matches) - (d - c - matches)
            assert aligned <= whole_alignment(template, words) and matches == len(template), t


def test_other_text_has_no_findings():
    for text in (None, b"", b"This work is licensed under a contract.", b"the software is fine " * 500):
        assert license_scan.scan(text, INDEX) == []


def test_repeated_notice_is_found_each_time():
    text = ". ".join([NOTICES["MIT"]] * 300)
    assert [f[0] for f in license_scan.scan(text.encode(), INDEX)] == ["MIT"] * 300


def test_documents_against_search_for_the_notices(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = {(r.doc_id, r.template) for r in license_scan.scan_documents(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        for name, notice in NOTICES.items():
            if notice in (r.text or ""):
                assert (r.doc_id, name) in found


def test_awkward_rows(spark, odd, none):
    assert license_scan.scan_documents(odd).collect() == []
    assert license_scan.scan_documents(none).collect() == []
    twice = spark.createDataFrame([(1, NOTICES["MIT"]), (1, NOTICES["MIT"])], "doc_id long, text string")
    rows = license_scan.scan_documents(twice).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def pays_to_stop(template, ids):
    """Whether some words at an end, matches and edits together, are worth nothing or less."""
    worth = [license_scan.MATCH if a == b else license_scan.OTHER for a, b in zip(template, ids, strict=True)]
    return any(sum(worth[:i]) <= 0 or sum(worth[-i:]) <= 0 for i in range(1, len(worth)) if license_scan.MATCH in (worth[:i] + worth[-i:]))


def test_short_templates_are_refused():
    with pytest.raises(ValueError, match="fewer"):
        license_scan.Index({"x": "two words"})


def test_a_short_notice_with_one_other_word_is_found():
    found = {f[0]: f[1] for f in license_scan.scan(b"Some code. Released under an MIT License. More.", INDEX)}
    assert found["MIT"] == 0.8


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_no_edited_notice_is_missed(name):
    """Wherever the words of a finding are replaced, the fingerprints left over pick it as a candidate."""
    rng = random.Random(name)
    template = license_scan.words_of(NOTICES[name].encode())
    allowed = license_scan.edits_allowed(len(template))
    for i in range(200):
        words = list(template)
        for at in rng.sample(range(len(words)), rng.randint(max(0, min(allowed, len(words) // 4)), allowed) if i else allowed):
            words[at] = b"zz" + str(rng.randrange(9)).encode()
        text = b" ".join([b"aa"] * 7 + words + [b"bb"] * 7)
        ids = np.array([INDEX.numbers.get(w, 0) for w in words])
        t = INDEX.names.index(name)
        left = int((ids == INDEX.words[t]).sum())
        found = [f for f in license_scan.scan(text, INDEX) if f[0] == name]
        assert left >= license_scan.COVERAGE * len(template)
        # A local alignment, whole-matrix or not, may stop before matches that do not pay for the edits between.
        kept = license_scan.MATCH * left - (len(words) - left)
        assert found or whole_alignment(INDEX.words[t], ids) >= kept and pays_to_stop(INDEX.words[t], ids)


def test_interleaved_and_spread_copies_are_both_found():
    one, two = NOTICES["ISC-text"].split(), NOTICES["BSD-text"].split()
    both = [w for i in range(0, 60, 6) for w in one[i : i + 6] + ["x"]]
    text = " ".join(both[:20] + ["filler"] * 5 + both[20:] + two + ["y"] * 3 + two)
    found = [f[0] for f in license_scan.scan(text.encode(), INDEX)]
    assert found.count("BSD-text") == 2 and found.count("ISC-text") == 1


def test_alignment_reads_its_words_in_one_piece():
    """Gathering them row by row took most of the scan's time."""
    gathered = []

    class Words(np.ndarray):
        def __getitem__(self, at):
            gathered.extend([at] if isinstance(at, np.ndarray) else [])
            return super().__getitem__(at)

    template = np.arange(1, 41, dtype=np.int64)
    words = np.concatenate([np.zeros(5, np.int64), template, np.zeros(3, np.int64)]).view(Words)
    assert license_scan.align(template, words, 5) == (40, 0, 40, 5, 45)
    # Bands that begin before the words and end behind them.
    assert license_scan.align(template, words[5:25], 0) == (20, 0, 20, 0, 20)
    assert license_scan.align(template, words[25:45], -20) == (20, 20, 40, 0, 20)
    assert not gathered
