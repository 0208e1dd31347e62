"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annalist.llm import byte_bpe, importance, license_scan, line_dedup, mixing, near_vectors, ngram_join, pieces, pii, quality, sharding, vector_codes, winnowing
from annalist.llm.tables import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": lambda spark, sf_dir: license_scan.scan_documents(documents(spark, sf_dir)),
    "op2_pieces": lambda spark, sf_dir: pieces.encoded(documents(spark, sf_dir)),
    "op3_personal_data": lambda spark, sf_dir: pii.find_personal_data(documents(spark, sf_dir)),
    "op4_ngram_join": lambda spark, sf_dir: ngram_join.similar_documents(documents(spark, sf_dir)),
    "op5_sharding": lambda spark, sf_dir: sharding.sharded(documents(spark, sf_dir)),
    "op6_line_dedup": lambda spark, sf_dir: line_dedup.line_counts(documents(spark, sf_dir)),
    "op7_near_vectors": lambda spark, sf_dir: near_vectors.near_vectors(table(spark, sf_dir, "embeddings")),
    "op8_quality": lambda spark, sf_dir: quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels")),
    "op9_mixing": lambda spark, sf_dir: mixing.mixed(documents(spark, sf_dir)),
    "op10_winnowing": lambda spark, sf_dir: winnowing.fingerprints(documents(spark, sf_dir)),
    "op11_importance": lambda spark, sf_dir: importance.importance(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")),
    "op12_byte_bpe": lambda spark, sf_dir: byte_bpe.byte_tokens(documents(spark, sf_dir)),
    "op13_vector_codes": lambda spark, sf_dir: vector_codes.vector_codes(table(spark, sf_dir, "embeddings")),
}

ORACLES: dict[str, str] = {
    "op5_sharding": sharding.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_near_vectors": near_vectors.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_winnowing": winnowing.ORACLE,
    "op11_importance": importance.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
