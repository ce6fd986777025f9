"""Queries of the llm operators over whole tables, and SQL twins where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, line_dedup, packing, quality, simhash, suffix_dedup, surrogates, token_count, topk

#: The key of the surrogates in the registered queries; a deployment passes its own.
SURROGATE_KEY = b"terraloom"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_table(spark, sf_dir, "documents"))


def op4_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(_table(spark, sf_dir, "conversations"))


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).drop("text_hash", "char_distance", "word_distance")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymise(_table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.selectExpr("doc_id", "text", "size(__entities) AS n_entities", "__entities AS entities")


def op9_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def queries():
    every = (op1_simhash_neardup, op2_suffix_dedup, op3_line_dedup, op4_chat_tool_calls, op5_hilbert_packing, op6_quality_divergence, op7_byte_bpe, op8_pii_surrogates, op9_bit_sliced_topk, op10_token_counts)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_tool_calls": chat.ORACLE, "op6_quality_divergence": quality.oracle(), "op9_bit_sliced_topk": topk.oracle()}
