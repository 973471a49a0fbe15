"""Registered queries over the whole ``documents`` table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (
    bpe_tree,
    exact_dedup,
    kneser_ney,
    langid_crf,
    licence_rules,
    line_dedup,
    pairwise_quality,
    prefix_trie,
    qgram_decontam,
    sentence_spans,
    simhash,
    suffix_dedup,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_crf.languages(table(spark, sf_dir, "documents"))


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.digests(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS code_points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS own_text
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY own_text) AS group_size,
       first_value(doc_id) OVER same = doc_id AS kept,
       sha256(own_text) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY own_text ORDER BY code_points DESC, doc_id)
"""


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_decontam.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scores(table(spark, sf_dir, "documents"))


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_rules.licences(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_langid_crf": op1_langid_crf,
        "op2_bpe_tree": op2_bpe_tree,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_sentence_spans": op4_sentence_spans,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op7_qgram_decontamination": op7_qgram_decontamination,
        "op8_kneser_ney": op8_kneser_ney,
        "op9_pairwise_quality": op9_pairwise_quality,
        "op10_licence_rules": op10_licence_rules,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_line_dedup": op12_line_dedup,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op5_exact_dedup": OP5_SQL,
        "op10_licence_rules": licence_rules.oracle_sql(),
        "op12_line_dedup": line_dedup.ORACLE_SQL,
        "op13_prefix_trie": prefix_trie.ORACLE_SQL,
    }
