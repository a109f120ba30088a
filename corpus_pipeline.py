"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import common, exact_dedup, jaccard_join, language, packing, secret_scan

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (null, or no letter); fill a missing ``lang``."""
    return language.known_language(docs, language.learn(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest ``doc_id``."""
    return exact_dedup.keep_first_seen(docs, exact_dedup.new_index(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) keep the smallest ``doc_id``."""
    return jaccard_join.keep_one_of_each_group(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the text by a label; no document is dropped."""
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: SQL has no words for the classifier, the similarity join and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
