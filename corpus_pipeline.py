"""A training corpus from the table ``documents``.

Five stages, each working on all that the one before kept; each result is
written as Parquet to the shared folder and read again by the next:

1. quality rules: documents below the base rule or beyond the fences of their
   language and source go;
2. near-duplicates: one document of each group stays;
3. substring dedup: passages that occur in an earlier document are cut out;
4. mixing: sources are taken to their target weights (a document once, twice
   or not at all);
5. packing: the documents become pieces of 2048-token sequences.

All stages but the last return the columns of ``documents``.

Defined cases, for every stage: null texts are empty (and are rejected by the
first), null ids, languages and sources are values of their own, rows alike in
every column are judged each and all but one go as near-duplicates; a text of any length is
worked on whole; an empty table passes through empty; further columns of the
input are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import mixing, near, packing, passages, quality
from orderflow.llm.catalog import documents, tokenizer_file
from orderflow.session import configure, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return near.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return passages.strip_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

# The rows depend on the best-fit search and the tokenizer, which SQL cannot
# express; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
