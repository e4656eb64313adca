"""From raw documents to tokens: the stages of the corpus pipeline, each one operator.

Each stage reads what its predecessor kept, written as Parquet, and works on all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from tidemark.llm.texts import importable
from tidemark.session import stage as staged


# Rows and bytes of the batches that Python gets: each worker holds a batch or two beside its tables.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    """Keep the workers of a stage small; a long run's executors have a full heap beside them."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, in no learned language, or without a language that has a quarter of it, go."""
    small_batches(spark)
    return language_id.accepted(docs, least=0.25)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the longest original stays."""
    return exact_dedup.keep_one(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents one stays."""
    small_batches(spark)
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document stands as often as the mix takes it, up to twice."""
    return mixing.mixed(docs, weights=(3, 1, 2), share_percent=150, max_epochs=2)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: a row of digests and counts for each document of the mix."""
    small_batches(spark)
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify),
    ("exact_dedup", dedup),
    ("near_dedup", dedup_near),
    ("mixing", mix),
    ("byte_bpe", encode),
]

# Language inference by expectation-maximisation and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = staged(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
