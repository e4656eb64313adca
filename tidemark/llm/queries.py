"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, chat_repair, chat_views, exact_dedup, language_id, main_text, metric_search, mixing, near_dedup, oracle, ranked_search, secrets, suffix_dedup, token_counts
from tidemark.llm.texts import importable, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op2_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return metric_search.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op4_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_views.views(table(spark, sf_dir, "conversations"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.members(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model, limit=1024)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share_percent=150, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.links(table(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.report(table(spark, sf_dir, "conversations"))


def _ready(query: Query) -> Query:
    return lambda spark, sf_dir: query(importable(spark), sf_dir)


REGISTRY: dict[str, Query] = {
    "op1_suffix_dedup": _ready(op1_suffix_dedup),
    "op2_metric_search": _ready(op2_metric_search),
    "op3_secrets": _ready(op3_secrets),
    "op4_chat_views": _ready(op4_chat_views),
    "op5_exact_dedup": _ready(op5_exact_dedup),
    "op6_token_counts": _ready(op6_token_counts),
    "op7_byte_bpe": _ready(op7_byte_bpe),
    "op8_language_id": _ready(op8_language_id),
    "op9_mixing": _ready(op9_mixing),
    "op10_near_dedup": _ready(op10_near_dedup),
    "op11_main_text": _ready(op11_main_text),
    "op12_ranked_search": _ready(op12_ranked_search),
    "op13_chat_repair": _ready(op13_chat_repair),
}
SQL: dict[str, str] = {
    "op2_metric_search": oracle.OP2,
    "op4_chat_views": oracle.OP4,
    "op5_exact_dedup": oracle.OP5,
    "op9_mixing": oracle.OP9,
    "op12_ranked_search": oracle.OP12,
    "op13_chat_repair": oracle.OP13,
}
