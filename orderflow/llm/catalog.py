"""Registered queries of this subpackage: the digest columns of each operator
over its whole table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import (
    dialogue, gam, imatch, lmscore, mixing, near, orcfiles, packing, passages, quality, search, sharding, sql,
    transducer)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file: the folder is a parameter of the environment
    (``TOKENIZER_DIR``), else the installed ``public_tokenizers`` names it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_stupid_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(documents(spark, sf_dir))


def op2_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir), ["doc_id"])


def op5_sampled_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(documents(spark, sf_dir))


def op7_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orcfiles.round_trip(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op10_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


def op11_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(table(spark, sf_dir, "conversations"))


def op13_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_stupid_backoff_scores": op1_stupid_backoff_scores,
    "op2_transducer_token_counts": op2_transducer_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_adaptive_quality": op4_adaptive_quality,
    "op5_sampled_splitter_shards": op5_sampled_splitter_shards,
    "op6_imatch_fingerprints": op6_imatch_fingerprints,
    "op7_orc_token_ids": op7_orc_token_ids,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_source_mixing": op9_source_mixing,
    "op10_minmax_near_dedup": op10_minmax_near_dedup,
    "op11_best_position_search": op11_best_position_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_additive_quality": op13_additive_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op1_stupid_backoff_scores": sql.lm_sql(),
    "op4_adaptive_quality": sql.quality_sql(),
    "op10_minmax_near_dedup": sql.near_sql(),
    "op11_best_position_search": sql.search_sql(),
}
