"""The corpus pipeline: rejects, duplicates, personal data, mixing and packing, in this order.

Each stage is a function of (spark, docs, folder) and returns a DataFrame; it
works on all rows the stage before it returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import mixing, packing, personal_data, quality_rules, simhash
from riskloom.llm.common import table
from riskloom.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of smallest id."""
    return simhash.keep_one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks."""
    return personal_data.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("personal_data", private),
    ("mix_sources", mixture),
    ("best_fit_packing", packed),
]

# The learned rules, the fingerprints and the packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
