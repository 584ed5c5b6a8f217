"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bin_packing import pack_documents
from tidemark.llm.common import table
from tidemark.llm.fuzzy_lines import fuzzy_lines
from tidemark.llm.grace_dedup import exact_groups
from tidemark.llm.hash_tree_sharding import shard_rows
from tidemark.llm.merkle_manifest import manifest_report
from tidemark.llm.ngram_join import jaccard_groups
from tidemark.llm.oracles import ORACLES
from tidemark.llm.page_diff import extract_main
from tidemark.llm.poisson_mixing import mix_sources
from tidemark.llm.preference_chat import neighbours, preference_pairs
from tidemark.llm.prefix_trie import conversation_trie
from tidemark.llm.quality_rules import quality_report
from tidemark.llm.suffix_dedup import repeated_bytes
from tidemark.llm.toxicity import toxicity_report

__all__ = ["ORACLES", "QUERIES"]

#: The vocabulary of byte_bpe_50k.json as ranks, and its splitting pattern.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(table(spark, sf_dir, "conversations"), *neighbours())


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("row")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_ngram_jaccard_join, op3_best_fit_packing, op4_sharding, op5_chat_formatting,
    op6_source_mixing, op7_html_extraction, op8_exact_dedup, op9_quality_rules, op10_line_dedup,
    op11_conversation_prefix_trie, op12_merkle_manifest, op13_toxicity)}
