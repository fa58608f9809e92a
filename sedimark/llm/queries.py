"""Registered queries of this subpackage: each operator over its whole table, and SQL where it can be said."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sedimark.llm import copies, language, merkle, mixing, pieces, quality, search, simhash, strata, tokens, toxicity, vectors, warc
from sedimark.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(read_table(spark, sf_dir, "pages"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read_table(spark, sf_dir, "documents"))


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op5_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.documents(read_table(spark, sf_dir, "documents"))


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.conversations(read_table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(read_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(read_table(spark, sf_dir, "documents"))


def op13_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.classes(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_pieces": op2_pieces,
    "op3_vectors": op3_vectors,
    "op4_language": op4_language,
    "op5_documents": op5_documents,
    "op5_search": op5_search,
    "op6_mixing": op6_mixing,
    "op7_tokens": op7_tokens,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_strata": op11_strata,
    "op12_merkle": op12_merkle,
    "op13_copies": op13_copies,
}

ORACLE: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op3_vectors": vectors.ORACLE,
    "op5_documents": search.DOCUMENTS_ORACLE,
    "op5_search": search.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op11_strata": strata.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_copies": copies.ORACLE,
}
