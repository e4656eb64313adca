"""Declared schemas. Readers never infer, and partition columns are declared too."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values in this module: the zone, and every layer's column names and types.
LOCAL_ZONE = "Asia/Jakarta"
MONEY = T.DecimalType(38, 18)


@dataclass(frozen=True)
class Feed:
    """One captured table: how its payload fields become bronze columns."""

    name: str
    text: tuple[tuple[str, str], ...]
    amounts: tuple[tuple[str, str], ...]
    # which clock fills sourceTsMs: the payload's source_ts, or the envelope's ts_ms
    source_clock: str
    # columns in bronze order between the amounts and the times
    tail_text: tuple[tuple[str, str], ...] = ()

    @property
    def amount_columns(self) -> list[str]:
        return [column for _, column in self.amounts]

    @property
    def text_columns(self) -> list[str]:
        return [column for _, column in self.text + self.tail_text]

    @property
    def checksum_columns(self) -> list[str]:
        """Columns compared between two sinks: key, version, first three amounts."""
        return ["assetId", "lsn", *self.amount_columns[:3]]

    @property
    def bronze_columns(self) -> list[str]:
        return [field.name for field in bronze_schema(self)]


KEY_TEXT = (
    ("asset_id", "assetId"),
    ("symbol", "symbol"),
    ("coin_name", "coinName"),
    ("currency", "currency"),
)

PRICES = Feed(
    name="market_prices",
    text=KEY_TEXT,
    amounts=(("price", "price"), ("market_cap", "marketCap"), ("volume_24h", "volume24h")),
    tail_text=(("coin_image", "coinImage"),),
    source_clock="payload",
)

CAPS = Feed(
    name="market_caps",
    text=KEY_TEXT,
    amounts=(
        ("market_cap", "marketCap"),
        ("circulating_supply", "circulatingSupply"),
        ("total_supply", "totalSupply"),
        ("max_supply", "maxSupply"),
    ),
    source_clock="envelope",
)

FEEDS = {feed.name: feed for feed in (PRICES, CAPS)}

SOURCE = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)


def payload_schema(feed: Feed) -> T.StructType:
    """Row image inside a change event. Amounts and times travel as text."""
    names = [
        *(name for name, _ in feed.text),
        *(name for name, _ in feed.amounts),
        *(name for name, _ in feed.tail_text),
        "event_time",
        "source_ts",
        "created_at",
    ]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def envelope_schema(feed: Feed) -> T.StructType:
    payload = payload_schema(feed)
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", payload),
            T.StructField("after", payload),
            T.StructField("source", SOURCE),
        ]
    )


def json_envelope_schema(feed: Feed) -> T.StructType:
    """The envelope as JSON text is read: numbers of the source as text, so that bad ones are seen."""
    source = T.StructType([T.StructField(f.name, T.StringType()) for f in SOURCE])
    return T.StructType([T.StructField(f.name, source) if f.name == "source" else f for f in envelope_schema(feed)])


def bronze_schema(feed: Feed) -> T.StructType:
    text = T.StringType()
    fields = [
        *((column, text) for _, column in feed.text),
        *((column, MONEY) for _, column in feed.amounts),
        *((column, text) for _, column in feed.tail_text),
        ("eventTimeMs", T.LongType()),
        ("sourceTsMs", T.LongType()),
        ("createdAtMs", T.LongType()),
        ("updatedAtMs", T.LongType()),
        ("op", text),
        ("lsn", T.LongType()),
        ("sourceDb", text),
        ("sourceSchema", text),
        ("sourceTable", text),
        ("ingestion_date", T.DateType()),
        ("ingestion_hour", text),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def landing_schema(feed: Feed) -> T.StructType:
    """Landing files: bronze columns, with the hour under its directory name."""
    return T.StructType(
        [
            T.StructField("hour" if f.name == "ingestion_hour" else f.name, f.dataType)
            for f in bronze_schema(feed)
        ]
    )


API_ASSET = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("current_price", MONEY),
        T.StructField("market_cap", MONEY),
        T.StructField("total_volume", MONEY),
        T.StructField("circulating_supply", MONEY),
        T.StructField("total_supply", MONEY),
        T.StructField("max_supply", MONEY),
    ]
)
