"""The corpus pipeline: documents to packed training sequences, in five stages.

Quality rules, exact dedup, near-dedup, mixing to target weights, packing. Each stage works on
all that its predecessor kept, is written as Parquet and read again. Nulls, empty texts, repeated
rows and empty tables are handled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringfold.llm import exact_dedup, mixing, packing, quality_rules, simhash
from ringfold.llm.common import documents, staged


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.keep_last(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated or left out."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.best_fit(docs)


STAGES = [("rules", rules), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: Tokenisation, SimHash components and the outlier estimates are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
