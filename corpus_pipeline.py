"""The corpus pipeline: quality rules, line dedup, near-duplicates, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import line_dedup, packing, quality, similar, surrogates
from terraloom.llm.registry import SURROGATE_KEY
from terraloom.scratch import materialise


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage has changed it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Null and empty texts go, as they have too few words; the rest is as quality.keep_good() has it."""
    return quality.keep_good(docs)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the chunks of lines that an earlier one has; see line_dedup.dedup_lines() for odd input."""
    return _recounted(line_dedup.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 on five-word shingles stays, that with the smallest doc_id."""
    return similar.keep_one_copy(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; see surrogates.pseudonymise() for odd input."""
    return _recounted(surrogates.pseudonymise(docs, SURROGATE_KEY, spans_col=None))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence, as packing.pack() returns them with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_rules), ("lines", line_chunks), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

#: SQL can't state line chunks, SimHash or tokens; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
