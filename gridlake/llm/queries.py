"""The registered queries of this subpackage: thin forms of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import attention_mil, bpe_tree, importance_resampling, language_id, licences, quality_rules, quote_links, secrets, sentence_spans, simhash, suffixes, token_shards, vector_codes
from .oracles import ORACLE_SQL as ORACLE_SQL
from .runtime import documents


def op1_byte_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree-wise byte-level BPE of every whole text, and its bytes decoded from the ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_tree.token_digests(bpe_tree.encode_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN))


def op2_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences among the canonical units of every whole text."""
    return licences.licence_report(documents(spark, sf_dir))


def op3_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by pattern and by the randomness battery in every whole text."""
    return secrets.secret_report(documents(spark, sf_dir))


def op4_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, with what it replies to and its place in reply order."""
    return quote_links.conversation_report(documents(spark, sf_dir, "conversations"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of every whole text that repeat a passage of an earlier document or place."""
    return sentence_spans.dedup_report(documents(spark, sf_dir))


def op6_simhash_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of every whole text and the components of near fingerprints."""
    return simhash.near_duplicate_report(documents(spark, sf_dir))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, written to binary shards with a perfect hash index and read back."""
    return token_shards.shard_report(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every whole text."""
    return attention_mil.quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op10_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every whole text."""
    return suffixes.contamination_report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op7_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every whole text and the verdict of the rule cascade."""
    return quality_rules.quality_report(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, found by equal-average search."""
    return vector_codes.compression_report(documents(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every whole text against the benchmark's n-grams, and the rank of those drawn."""
    return importance_resampling.resampling_report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text."""
    return language_id.language_report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe_tree": op1_byte_bpe_tree,
    "op2_licence_digests": op2_licence_digests,
    "op3_secret_randomness": op3_secret_randomness,
    "op4_quote_links": op4_quote_links,
    "op5_sentence_spans": op5_sentence_spans,
    "op6_simhash_slices": op6_simhash_slices,
    "op7_quality_cascade": op7_quality_cascade,
    "op8_token_shards": op8_token_shards,
    "op9_attention_mil": op9_attention_mil,
    "op10_suffix_decontamination": op10_suffix_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_language_id": op13_language_id,
}
