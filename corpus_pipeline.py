"""A corpus pipeline of the operators in riskspark.llm: each stage takes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import language_id, packing, secret_scan, simhash, suffix_dedup


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those that the operator rejects (und) go."""
    return language_id.keep_known(docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.keep_first(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; a text that has nothing left goes."""
    return suffix_dedup.cut_repeats(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.digest(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("simhash_dedup", keep_one_of_group),
    ("suffix_dedup", remove_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Hashing with XXH64, the tokenizer and the packing have no counterpart in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskspark.llm._shared import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        held = list(Scratch.live)
        kept = scratch.table(stage(spark, docs, sf_dir))
        # a stage's own tables are not needed once its result is written, nor is what it has read
        for own in [s for s in Scratch.live if s not in held]:
            own.clear()
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
