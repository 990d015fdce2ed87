"""From raw documents to packed training sequences: each stage reads what the one before wrote.

language identification -> exact duplicates -> near duplicates -> mixing -> packing
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import exact, jaccard, langid, mixing, packing
from claimloom.llm.common import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: those without a letter, or in no language for the most part."""
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z and a-z alike) the largest ``doc_id`` stays."""
    return exact.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles the smallest ``doc_id`` stays: SimHash links, then the rest."""
    return jaccard.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until the sources have their target shares, in the order of the schedule."""
    return mixing.in_schedule_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into sequences of power-of-two lengths, in a bucket for each length; one row per sequence."""
    return packing.pack_in_buckets(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language models, fingerprints of shingles and tokenizers have no SQL form: tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
