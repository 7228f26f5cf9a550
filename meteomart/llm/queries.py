"""Registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meteomart.llm import (language_zstd, lbl, lsh_forest, merkle, packing, passages, piece_codec, pii, posting_lists,
                           prefix_trie, quality_qda, raking, token_alignment)
from meteomart.llm.tables import table


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared(table(spark, sf_dir, "documents"))


def op3_merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op4_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(table(spark, sf_dir, "documents"))


def op5_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"))


def op6_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_zstd.predict(docs, language_zstd.dictionaries(docs))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op8_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.decide(table(spark, sf_dir, "documents"))


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.classes(table(spark, sf_dir, "documents"))


def op10_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality_qda.score(docs, quality_qda.fit(docs, labels))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.digests(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_queries() -> dict[str, str]:
    return {"op3_merkle_tree": merkle.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
