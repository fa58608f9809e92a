"""A corpus, from raw documents to token ids: the stages in order, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimark.llm import language, mixing, pieces, simhash, toxicity
from sedimark.llm.tables import read_table, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a learned language stay."""
    return language.drop_rejected(docs)


def toxic_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxic threshold stay."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    return pieces.encoded(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic_passages),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("pieces", encode),
]

# Learned models and seeded segmentation are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
