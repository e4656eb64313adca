"""Gold: the asset dimension and the two fact tables.

``*_rows`` are the rows a bronze batch contributes. The tables keep the highest
version of each key, so they may be built whole or batch by batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant, epoch_to_local_time, event_month, local_event_date
from tidemark.operators.cdc import not_deleted
from tidemark.operators.state import replacing_dedup
from tidemark.plans.silver import OUTPUT_NAMES
from tidemark.schemas import CAPS, PRICES, Feed

FACT_KEY = ("asset_id", "event_time_ms")
DIM_KEY = ("asset_id",)


def dim_asset_rows(prices: DataFrame) -> DataFrame:
    return not_deleted(prices).select(
        F.col("assetId").alias("asset_id"),
        "symbol",
        F.col("coinName").alias("coin_name"),
        F.col("coinImage").alias("coin_image"),
        "currency",
        F.col("eventTimeMs").alias("last_event_time_ms"),
        epoch_to_local_time(F.col("eventTimeMs")).alias("last_event_time"),
        F.col("lsn").alias("last_lsn"),
        F.col("op").alias("last_op"),
    )


def dim_asset(
    prices: DataFrame, as_of: Column | datetime | None = None, keys: Sequence[str] = DIM_KEY
) -> DataFrame:
    """One row per asset: its attributes at the newest event that is not a delete."""
    newest = replacing_dedup(dim_asset_rows(prices), keys, "last_lsn")
    return newest.withColumn("updated_at", as_instant(as_of))


def fact_rows(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Fact rows before versions of the same (asset, time) are replaced."""
    return not_deleted(bronze).select(
        F.col("assetId").alias("asset_id"),
        F.col("eventTimeMs").alias("event_time_ms"),
        *[F.col(c).alias(OUTPUT_NAMES.get(c, c)) for c in feed.amount_columns],
        "currency",
        "lsn",
        "op",
        "ingestion_date",
        "ingestion_hour",
    )


def fact_table(rows: DataFrame, as_of: Column | datetime | None = None, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """Deduplicated facts. Columns that follow from others are added last, so
    the dedup shuffles only what it needs."""
    millis = F.col("event_time_ms")
    return replacing_dedup(rows, keys, "lsn").withColumns(
        {
            "event_time": epoch_to_local_time(millis),
            "event_date": local_event_date(millis),
            "event_month": event_month(millis),
            "loaded_at": as_instant(as_of),
        }
    )


def fct_market_prices(bronze: DataFrame, as_of: Column | datetime | None = None, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    return fact_table(fact_rows(bronze, PRICES), as_of, keys)


def fct_market_caps(bronze: DataFrame, as_of: Column | datetime | None = None, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    return fact_table(fact_rows(bronze, CAPS), as_of, keys)


def write_facts(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Facts by event month, ordered by key; months and assets may be uneven."""
    (
        facts.repartitionByRange("event_month", *FACT_KEY)
        .sortWithinPartitions("event_month", *FACT_KEY)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month")
        .parquet(path)
    )
