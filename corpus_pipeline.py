"""A corpus pipeline of five stages over ``documents``; each stage's table is written and read by the next one.

SQL can't express the stages (fingerprint links, randomness tests, byte-pair merges), so ``ORACLE_SQL`` is None. Tests
hold near-dedup and decontamination against brute force on what the stages before them kept; quality rules, secrets and
byte pairs are held against plain versions as operators, and as stages by which documents stay. Null and empty texts fail the quality rules; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import bpe_tree, near_copies, quality_rules, secrets, suffixes
from gridlake.llm.runtime import SMALL_SLICE, documents, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_copies.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return suffixes.decontaminated(docs, documents(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a tag, and their new lengths."""
    return secrets.redacted(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each document, with digests of ids and of the bytes decoded from them."""
    coded = bpe_tree.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, max_bytes=SMALL_SLICE)
    return bpe_tree.token_digests(coded, "ids")


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("byte_bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
