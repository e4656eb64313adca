"""Source-side rules: API pages, insert-or-ignore, table constraints."""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import decimal_or_null, iso_to_millis, text_or_null
from tidemark.operators.state import first_by
from tidemark.schemas import API_ASSET, MONEY
from tidemark.session import stage

# Fixed value: the currency pages are asked in.
CURRENCY = "usd"


# What an asset of a page must have, and its numbers.
ASSET_REQUIRED = ("id", "symbol", "name", "image", "last_updated", "current_price")
ASSET_NUMBERS = tuple(f.name for f in API_ASSET if f.dataType == MONEY)


def api_assets(pages: DataFrame, body: str = "body", page: str = "page") -> tuple[DataFrame, DataFrame]:
    """The assets of JSON array pages as struct ``a``, and the rejects: page, reason, body.

    A page that is no whole JSON array is rejected as a whole. An asset is
    rejected, with its own text, for the first required field it lacks, a time
    without offset, or a number that is none. Every asset of a readable page comes
    out on one side or the other.

    Pages are read and judged once, and staged: a filter on the reason would otherwise
    move below the parser and parse each asset again for every rule. Numbers are read
    in a loop over them, as their rules written out for each make methods too large.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in API_ASSET])
    items = F.from_json(F.col(body), T.ArrayType(T.StringType()))
    whole = F.coalesce(F.col("body").rlike(r"^\s*\[") & F.col("body").rlike(r"\]\s*\z") & F.col("items").isNotNull(), F.lit(False))
    listed = F.transform("items", lambda item: F.struct(F.lit(True).alias("listed"), item.alias("body")))
    alone = F.array(F.struct(F.lit(False).alias("listed"), F.col("body").alias("body")))
    marked = pages.select(F.col(page).alias("page"), F.col(body).alias("body"), items.alias("items"))
    # outer, as an inner one would have its pages parsed twice, to leave out empty ones first
    texts = marked.select("page", F.explode_outer(F.when(whole, listed).otherwise(alone)).alias("text")).filter("text is not null")
    fields = texts.select("page", "text.*").withColumn("t", F.when(F.col("listed"), F.from_json("body", as_text)))
    read = fields.withColumn("numbers", F.transform(F.array(*[f"t.{c}" for c in ASSET_NUMBERS]), decimal_or_null))
    number = {c: F.get("numbers", F.lit(n)) for n, c in enumerate(ASSET_NUMBERS)}
    faults = [F.when(~F.col("listed"), F.lit("page is not a JSON array"))]
    faults += [F.when(F.coalesce(text_or_null(F.col(f"t.{c}")), F.lit("")) == "", F.lit(f"{c} is missing")) for c in ASSET_REQUIRED]
    faults.append(F.when(iso_to_millis(F.col("t.last_updated")).isNull(), F.lit("last_updated is no time with offset")))
    faults += [F.when(F.col(f"t.{c}").isNotNull() & number[c].isNull(), F.lit(f"{c} is no decimal(38,18)")) for c in ASSET_NUMBERS]
    typed = F.struct(*[number.get(f.name, F.col(f"t.{f.name}")).alias(f.name) for f in API_ASSET])
    own = F.when(F.col("listed"), F.coalesce("body", F.lit("null"))).otherwise(F.col("body"))
    rejected = F.col("reason").isNotNull()
    judged = read.withColumn("reason", F.coalesce(*faults)).select(
        "page", "reason", F.when(~rejected, typed).alias("a"), F.when(rejected, own).alias("body")
    )
    held = stage(judged, "assets")
    return held.filter(~rejected).select("page", "a"), held.filter(rejected).select("page", "reason", "body")


def api_page_explode(
    pages: DataFrame, body: str = "body", loaded_at: Column | None = None, page: str = "page"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Price rows and cap rows of JSON array pages, one of each per asset, and the rejects."""
    clock = F.current_timestamp() if loaded_at is None else loaded_at
    accepted, rejected = api_assets(pages, body, page)
    assets = accepted.select("a", clock.alias("source_ts"))
    identity = [
        F.col("a.id").alias("asset_id"),
        F.col("a.symbol").alias("symbol"),
        F.col("a.name").alias("coin_name"),
        F.lit(CURRENCY).alias("currency"),
    ]
    event_time = F.timestamp_millis(iso_to_millis(F.col("a.last_updated"))).alias("event_time")
    prices = assets.select(
        *identity,
        F.col("a.current_price").alias("price"),
        F.col("a.market_cap").alias("market_cap"),
        F.col("a.total_volume").alias("volume_24h"),
        F.col("a.image").alias("coin_image"),
        event_time,
        "source_ts",
    )
    caps = assets.select(
        *identity,
        F.col("a.market_cap").alias("market_cap"),
        F.col("a.circulating_supply").alias("circulating_supply"),
        F.col("a.total_supply").alias("total_supply"),
        F.col("a.max_supply").alias("max_supply"),
        event_time,
        "source_ts",
    )
    return prices, caps, rejected


def page_inserts(
    rows: DataFrame, target: DataFrame, rules: TableRules, created_at: Column, within: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """What rows of pages add to their table, and the rows its constraints refuse, with the violation.

    Of rows that repeat a key the first by source time is inserted, as the table
    would ignore the later ones; keys that the table holds already add nothing.
    ``within`` names the key column that chooses what of the table is read.
    """
    made = rows.withColumn("created_at", created_at)
    first = first_by(made, list(rules.key), ["source_ts"])
    checked = constraint_check(first, rules)
    good = checked.filter("violation is null").drop("violation")
    if within is not None:
        good = stage(good, "page-inserts")
    return anti_existing(good, target, list(rules.key), within), checked.filter("violation is not null")


# Ranges of values that choose what of a target is read.
MOST_RANGES = 64
SLOTS = 1024


def value_ranges(batch: DataFrame, column: str, most: int = MOST_RANGES) -> list[tuple]:
    """At most ``most`` ranges that hold all values of a column, null ones left out, and leave out its widest gaps.

    Its span is cut into slots, and of each slot with values the least and the greatest
    reach the driver; neighbours are joined, across the smallest gaps first. So a late row
    is a range of its own and does not widen the others. The column is a number, a date or
    a time; a text is one range from least to greatest.
    """
    kind = batch.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(value).cast("double")
    elif isinstance(kind, T.NumericType):
        number = value.cast("double")
    else:
        number = F.lit(0.0)
    kept = batch.where(value.isNotNull()).select(value.alias("v"), number.alias("x"))
    least, greatest = kept.agg(F.min("x"), F.max("x")).first()
    if least is None:
        return []
    width = (greatest - least) / SLOTS or 1.0
    if not math.isfinite(width):
        return [tuple(kept.agg(F.min("v"), F.max("v")).first())]
    slot = F.least(F.floor((F.col("x") - least) / width), F.lit(SLOTS - 1))
    found = kept.groupBy(slot.alias("slot")).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.min("x").alias("xa"), F.max("x").alias("xb"))
    slots = sorted(found.collect(), key=lambda r: r.xa)
    gaps = sorted((after.xa - before.xb for before, after in zip(slots, slots[1:])), reverse=True)
    # gaps within a slot's width are none
    open_gap = max(gaps[most - 1] if len(gaps) >= most else 0.0, width)
    ranges = [[slots[0].a, slots[0].b]]
    for before, after in zip(slots, slots[1:]):
        if after.xa - before.xb > open_gap:
            ranges.append([after.a, after.b])
        else:
            ranges[-1][1] = after.b
    return [tuple(r) for r in ranges]


def within_ranges(target: DataFrame, column: str, ranges: Sequence[tuple]) -> DataFrame:
    """The target's rows in any of the ranges: prunes partitions, files and row groups."""
    chosen = [F.col(column).between(F.lit(a), F.lit(b)) for a, b in ranges]
    return target.filter(reduce(operator.or_, chosen) if chosen else F.lit(False))


def anti_existing(batch: DataFrame, target: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """Batch rows whose key is not in the target. Only the target's keys are read.

    ``within`` names a key column, such as the time or day the target is laid out
    by: the target is read only where that column is near the batch's values of it.
    The batch is read three times then, so give one that is stored. A null in it
    matches nothing, as in any join.
    """
    if within is not None:
        target = within_ranges(target, within, value_ranges(batch, within))
    return batch.join(target.select(*keys), list(keys), "left_anti")


def insert_ignore(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], arrival: Sequence[str], within: str | None = None
) -> DataFrame:
    """Rows a batch adds when existing keys are left alone: the first write wins."""
    first = first_by(batch, keys, arrival)
    return anti_existing(stage(first, "arriving") if within is not None else first, target, keys, within)


@dataclass(frozen=True)
class TableRules:
    """NOT NULL columns, numeric (precision, scale) limits and the primary key."""

    required: tuple[str, ...]
    numeric: tuple[tuple[str, int, int], ...]
    key: tuple[str, ...]


# The key, NOT NULL columns and numeric limits of both source tables.
MARKET_KEY = ("asset_id", "currency", "event_time")
PRICE_RULES = TableRules(
    required=(
        "asset_id", "symbol", "coin_name", "currency", "price", "coin_image",
        "event_time", "source_ts", "created_at",
    ),
    numeric=(("price", 18, 8), ("market_cap", 18, 2), ("volume_24h", 18, 2)),
    key=MARKET_KEY,
)
CAP_RULES = TableRules(
    required=(
        "asset_id", "symbol", "coin_name", "currency", "event_time", "source_ts", "created_at",
    ),
    numeric=(
        ("market_cap", 18, 2), ("circulating_supply", 20, 4), ("total_supply", 20, 4), ("max_supply", 20, 4),
    ),
    key=MARKET_KEY,
)


def constraint_check(df: DataFrame, rules: TableRules) -> DataFrame:
    """Add ``violation``: the first broken rule of each row, or null.

    A frame that lacks a column of the rules is an error, not a pass.

    A numeric limit is broken when the value, rounded to the column's scale,
    has too many integer digits. Repeated keys are counted by a grouped count
    and joined back, never by a window over one key's rows. They are staged, so
    that Spark knows their size: where they are few the rows need no shuffle.
    """
    absent = {*rules.required, *(c for c, _, _ in rules.numeric), *rules.key} - set(df.columns)
    if absent:
        raise ValueError(f"columns of the rules are absent: {', '.join(sorted(absent))}")
    broken: list[Column] = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in rules.required]
    for column, precision, scale in rules.numeric:
        value = F.round(F.abs(F.col(column)), scale)
        # as narrow as it can be: a wider type would round the value it meets
        limit = F.lit("1" + "0" * (precision - scale)).cast(f"decimal({precision - scale + 1},0)")
        broken.append(F.when(value >= limit, F.lit(f"{column} exceeds numeric({precision},{scale})")))
    keys = list(rules.key)
    repeated = stage(df.groupBy(*keys).count().filter("count > 1").select(*keys), "repeated-keys")
    marked = df.join(repeated.withColumn("_repeated", F.lit(True)), keys, "left")
    duplicate = F.when(F.col("_repeated"), F.lit(f"duplicate key ({', '.join(keys)})"))
    return marked.select(*df.columns, F.coalesce(*broken, duplicate).alias("violation"))
