"""Queries of the corpus operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from importlib import import_module


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _query(module: str, table: str = "documents"):
    def run(spark, sf_dir):
        return import_module(f"{__package__}.{module}").digest(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    return run


def op10_sharding(spark, sf_dir):
    from .sharding import shard

    return shard(_docs(spark, sf_dir))


QUERIES = {
    "op1_embedding_dedup": _query("embedding_dedup", "embeddings"),
    "op2_secret_scan": _query("secret_scan"),
    "op3_sentencepiece": _query("sentencepiece_codec"),
    "op4_suffix_dedup": _query("suffix_dedup"),
    "op5_language_id": _query("language_id"),
    "op6_simhash_dedup": _query("simhash"),
    "op7_quality_rules": _query("quality_rules"),
    "op8_bestfit_packing": _query("packing"),
    "op9_token_store": _query("token_store"),
    "op10_sharding": op10_sharding,
}


#: Queries that SQL can express on whole tables of the test size, and the modules that hold the SQL.
EXPRESSED = {
    "op1_embedding_dedup": "embedding_dedup",
    "op2_secret_scan": "secret_scan",
    "op4_suffix_dedup": "suffix_dedup",
    "op7_quality_rules": "quality_rules",
    "op10_sharding": "sharding",
}


def oracles() -> dict[str, str]:
    return {name: import_module(f"{__package__}.{module}").oracle() for name, module in EXPRESSED.items()}
