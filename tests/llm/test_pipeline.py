import numpy as np

import corpus_pipeline
from annalist.llm import quality
from annalist.llm.pieces import decode, read_vocabulary
from annalist.llm.tables import documents, table
from tests.llm.plain import similar, without_lines

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage on what the one before it kept."""
    docs, kept = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "pieces":
            assert out.schema == docs.schema
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    first = [(r.doc_id, r.text) for r in kept[0]]
    good = quality.classify(documents(spark, SF), table(spark, SF, "labels")).where("predicted = 1").collect()
    assert sorted(d for d, _ in first) == sorted(r.doc_id for r in good)
    second = [(r.doc_id, r.text) for r in kept[1]]
    assert sorted(second) == sorted((d, t) for d, _, _, t in without_lines(first))
    third = [(r.doc_id, r.text) for r in kept[2]]
    stay = {d for d, _, c in similar(second) if d == c}
    assert sorted(third) == sorted(x for x in second if x[0] in stay)
    fourth = [(r.doc_id, r.text) for r in kept[3]]
    assert set(fourth) <= set(third) and max(fourth.count(x) for x in fourth) <= 3
    vocabulary = read_vocabulary()
    assert sorted((r.doc_id, decode(r.pieces, vocabulary)) for r in kept[4]) == sorted(fourth)
    assert len(kept[4]) == corpus_pipeline.run(spark, SF).count()


def test_clean_documents_are_kept(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in corpus_pipeline.accept(spark, documents(spark, SF), SF).collect()}
    clean = [d for d, q in labels.items() if q == 1]
    assert np.mean([d in kept for d in clean]) >= 0.98


def test_stages_take_awkward_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns), name
            assert (out.count() == 0) == (docs is none)
