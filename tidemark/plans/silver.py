"""Silver: the latest live state of each asset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import epoch_to_local_time
from tidemark.operators.state import STATE_KEYS, live, partial_state
from tidemark.schemas import CAPS, PRICES, Feed

OUTPUT_NAMES = {
    "assetId": "asset_id",
    "coinName": "coin_name",
    "marketCap": "market_cap",
    "volume24h": "volume_24h",
    "circulatingSupply": "circulating_supply",
    "totalSupply": "total_supply",
    "maxSupply": "max_supply",
    "eventTimeMs": "event_time_ms",
}
IDENTITY = ("symbol", "coinName", "currency")


def state_payload(feed: Feed) -> list[str]:
    """Columns of the state beside key and version."""
    return [*IDENTITY, *feed.amount_columns, "op"]


def latest_state(bronze: DataFrame, feed: Feed, keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    """Newest event per asset with its whole row, deletes included."""
    payload = [c for c in state_payload(feed) if c not in keys]
    return partial_state(bronze, payload, keys)


def silver_view(state: DataFrame, feed: Feed) -> DataFrame:
    """Merged state to the view users query: live assets only."""
    columns = ["assetId", *IDENTITY, *feed.amount_columns, "eventTimeMs"]
    shown = live(state).select(*[F.col(c).alias(OUTPUT_NAMES.get(c, c)) for c in columns])
    return shown.withColumn("event_time", epoch_to_local_time(F.col("event_time_ms")))


def silver_prices(bronze: DataFrame, keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    return silver_view(latest_state(bronze, PRICES, keys), PRICES)


def silver_caps(bronze: DataFrame, keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    return silver_view(latest_state(bronze, CAPS, keys), CAPS)
