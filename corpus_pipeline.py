"""The corpus pipeline over ``documents``: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; run() writes each stage's result in
the shared folder and reads it again for the next. Nulls, empty tables, ties, repeated rows and other columns are as
the operators define them; all stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from digestloom.llm import dedup, minhash, mixing, packing, quality
from digestloom.llm.common import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the smallest doc_id stays."""
    return dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row of the smallest doc_id stays."""
    return minhash.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]

#: SQL can express neither the sampled near-duplicate search nor the tokeniser: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
