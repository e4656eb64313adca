"""The market overview: one row per asset with rank, liquidity and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cdc import star_except
from tidemark.operators.ranking import global_total, market_cap_rank, share_of_total
from tidemark.operators.state import latest_nonnull_by_time
from tidemark.session import stage


def latest_prices(facts: DataFrame) -> DataFrame:
    return latest_nonnull_by_time(
        facts,
        ["asset_id"],
        ["price", "volume_24h", "market_cap"],
        ["event_time_ms"],
        [F.max("event_time").alias("last_event_time")],
    )


def latest_caps(facts: DataFrame) -> DataFrame:
    supplies = ["circulating_supply", "total_supply", "max_supply"]
    return latest_nonnull_by_time(facts, ["asset_id"], supplies, ["event_time_ms"])


def left_equi(prices: DataFrame, caps: DataFrame) -> DataFrame:
    """Every priced asset, with its supplies where known. Both sides are unique
    and already partitioned by asset, so the join adds no shuffle."""
    return prices.join(caps, "asset_id", "left").select(
        "asset_id", "price", "volume_24h", "market_cap",
        "circulating_supply", "total_supply", "max_supply", "last_event_time",
    )


def market_overview(price_facts: DataFrame, cap_facts: DataFrame) -> DataFrame:
    """Latest figures per asset. The per-asset rows are staged once; totals,
    rank and shares then work on that much smaller table."""
    merged = stage(left_equi(latest_prices(price_facts), latest_caps(cap_facts)), "overview")
    ranked = market_cap_rank(merged)
    wholes = {"all_caps": "market_cap", "all_supply": "circulating_supply"}
    totalled = global_total(ranked, wholes, over=merged)
    shared = share_of_total(totalled, "volume_24h", "market_cap", "liquid_indicator_24h")
    shared = share_of_total(shared, "market_cap", "all_caps", "market_dominance")
    shared = share_of_total(shared, "circulating_supply", "all_supply", "supply_dominance")
    return star_except(shared, "all_caps", "all_supply")
