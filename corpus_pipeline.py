"""The corpus pipeline: quality, exact dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and returns a DataFrame that ``run``
writes to the shared folder and reads again for the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import exact_dedup, packing, quality, simhash
from tideline.llm.queries import quality_model, table, tokenizer
from tideline.session import settle


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints, the one with the smallest doc_id."""
    return simhash.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in sequences of 4096 tokens."""
    pieces = packing.pack_documents(docs, tokenizer=tokenizer())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

ORACLE_SQL = None  # a fitted model, XXH64 fingerprints and tokenizers are beyond SQL: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
