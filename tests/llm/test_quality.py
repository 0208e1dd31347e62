import zlib

import numpy as np

from annalist.llm import quality
from annalist.llm.tables import documents, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    rows = quality.classify(documents(spark, SF), labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.97


def test_folds_scores_and_decisions(spark):
    rows = quality.classify(documents(spark, SF), table(spark, SF, "labels")).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= quality.THRESHOLD)


def test_labels_of_held_out_rows_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    other = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: round(r.score, 9) for r in quality.classify(docs, x).collect()} for x in (labels, other)]
    assert scores[0] == scores[1]


def test_awkward_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 18)] * 2 + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality.classify(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    by_text = {}
    for r in out:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[7]) == 1 and len(by_text[4] | by_text[5]) == 1
    assert quality.classify(none, labels).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert {(round(r.score, 2), r.predicted) for r in quality.classify(odd, nothing).collect()} == {(0.5, 1)}


def test_accepted_rows_are_those_predicted(spark):
    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    kept = quality.accepted(docs, labels)
    assert kept.schema == docs.schema
    want = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_isotonic_fit():
    x, y = quality.isotonic(np.arange(5.0), np.array([0, 0.6, 0.4, 0.5, 1]), np.ones(5))
    assert y.tolist() == [0, 0.5, 1] and np.allclose(x, [0, 2, 4])
    assert (np.diff(y) > 0).all()
