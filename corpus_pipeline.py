"""Corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

``STAGES`` lists named functions of ``(spark, docs, sf_dir)``. Each takes the documents
that the stage before it kept; all but the last return documents, the last one their
tokens. ``run`` applies them to the ``documents`` table and stores every stage as Parquet
in the shared folder, so a lost executor costs at most the stage that runs.

Every stage takes null and repeated rows, awkward texts, empty tables and further columns
as the docstring of its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe_tree, exact_dedup, pairwise_quality, qgram_decontam, simhash
from tidemark.llm.storage import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality model accepts."""
    return pairwise_quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: four-word shingles, at most four bits apart."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return qgram_decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_tree.digests(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokenize),
]

#: Learned scores, fingerprint components and alignments are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
