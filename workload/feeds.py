"""The driver's tables as change feeds, bronze rows and metric series.

``events`` plays the prices feed and ``orders`` the caps feed. Every function
reads whole tables and stays a projection unless it says otherwise.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import ingest_stamp
from tidemark.operators.series import carry_forward, chunked, running_total
from tidemark.schemas import CAPS, PRICES, bronze_schema, envelope_schema

PRICES_AS_OF = datetime(2024, 1, 31)
CAPS_AS_OF = datetime(2001, 8, 2)
MONEY = "decimal(38,18)"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DELETED_PRIORITY = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A JSON object of one whole number ``k``, as text.
ONLY_K = r'^\{"k": ?(0|-?[1-9][0-9]{0,8})\}\z'


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``at`` as an instant and ``k`` taken out of the JSON; objects of ``k`` alone need no parser."""
    alone = F.nullif(F.regexp_extract("props", ONLY_K, 1), F.lit(""))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("at"),
        F.coalesce(alone, F.get_json_object("props", "$.k")).cast("int").alias("k"),
    )


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def price_op() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "d").when(kind == "signup", "c").when(kind == "purchase", "r").otherwise("u")


def cap_op() -> Column:
    status = F.col("o_orderstatus")
    return (
        F.when(F.col("o_orderpriority") == DELETED_PRIORITY, "d")
        .when(status == "F", "c")
        .when(status == "O", "u")
        .otherwise("r")
    )


def price_market_cap() -> Column:
    k = F.col("k")
    return F.when(k < 10, F.lit(None)).when(k == 50, F.lit(0)).otherwise(k * 1000)


def bronze_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices feed already parsed; the event time serves as ingestion time."""
    user, micros = F.col("user_id").cast("string"), F.unix_micros("at")
    rows = events(spark, sf_dir).select(
        F.concat(F.lit("a"), user).alias("assetId"),
        F.concat(F.lit("s"), user).alias("symbol"),
        F.concat(F.lit("Coin "), user, F.lit("."), "k").alias("coinName"),
        F.lit("usd").alias("currency"),
        F.col("value").cast("decimal(18,2)").cast(MONEY).alias("price"),
        price_market_cap().cast(MONEY).alias("marketCap"),
        (F.col("k") + 1).cast(MONEY).alias("volume24h"),
        F.concat(F.lit("https://img.example/a"), user, F.lit(".png")).alias("coinImage"),
        _div(micros, 1000).alias("eventTimeMs"),
        _div(micros + 250_000, 1000).alias("sourceTsMs"),
        _div(micros + 1_000_000, 1000).alias("createdAtMs"),
        F.lit(None).cast("bigint").alias("updatedAtMs"),
        price_op().alias("op"),
        F.col("event_id").alias("lsn"),
        F.lit("market").alias("sourceDb"),
        F.lit("public").alias("sourceSchema"),
        F.lit(PRICES.name).alias("sourceTable"),
        *ingest_stamp(F.col("at")),
    )
    return rows.select(*bronze_schema(PRICES).names)


def bronze_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caps feed already parsed; the order date serves as ingestion time."""
    at = F.col("o_orderdate").cast("timestamp")
    millis, customer = F.unix_millis(at), F.col("o_custkey").cast("string")
    supply = F.col("o_totalprice").cast("decimal(20,4)")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("a"), customer).alias("assetId"),
        F.concat(F.lit("s"), customer).alias("symbol"),
        F.concat(F.lit("Coin "), customer).alias("coinName"),
        F.lit("usd").alias("currency"),
        (supply * 10).cast(MONEY).alias("marketCap"),
        supply.cast(MONEY).alias("circulatingSupply"),
        (supply * 2).cast(MONEY).alias("totalSupply"),
        F.when(F.col("o_orderpriority") != "1-URGENT", (supply * 3).cast(MONEY)).alias("maxSupply"),
        millis.alias("eventTimeMs"),
        (millis + 500).alias("sourceTsMs"),
        (millis + 1000).alias("createdAtMs"),
        F.lit(None).cast("bigint").alias("updatedAtMs"),
        cap_op().alias("op"),
        F.col("o_orderkey").alias("lsn"),
        F.lit("market").alias("sourceDb"),
        F.lit("public").alias("sourceSchema"),
        F.lit(CAPS.name).alias("sourceTable"),
        *ingest_stamp(at),
    )
    return rows.select(*bronze_schema(CAPS).names)


def _iso(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), ISO)


def _envelope(feed, op: Column, payload: Column, lsn: Column, ts_ms: Column, schema: str = "public") -> Column:
    shape = envelope_schema(feed)
    image = payload.cast(shape["after"].dataType)
    nothing = F.lit(None).cast(shape["after"].dataType)
    return F.struct(
        op.alias("op"),
        F.when(op == "d", image).otherwise(nothing).alias("before"),
        F.when(op == "d", nothing).otherwise(image).alias("after"),
        F.struct(
            F.lit("market").alias("db"),
            F.lit(schema).alias("schema"),
            F.lit(feed.name).alias("table"),
            lsn.alias("lsn"),
            ts_ms.alias("ts_ms"),
        ).alias("source"),
    )


def _price_payload() -> Column:
    user, micros = F.col("user_id").cast("string"), F.unix_micros("at")
    return F.struct(
        F.concat(F.lit("a"), user).alias("asset_id"),
        F.concat(F.lit("s"), user).alias("symbol"),
        F.concat(F.lit("Coin "), user, F.lit("."), "k").alias("coin_name"),
        F.lit("usd").alias("currency"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("price"),
        price_market_cap().cast("string").alias("market_cap"),
        (F.col("k") + 1).cast("string").alias("volume_24h"),
        F.concat(F.lit("https://img.example/a"), user, F.lit(".png")).alias("coin_image"),
        _iso(micros).alias("event_time"),
        _iso(micros + 250_000).alias("source_ts"),
        _iso(micros + 1_000_000).alias("created_at"),
    )


def _price_envelope(payload: Column, op: Column | None = None) -> Column:
    ts_ms = _div(F.unix_micros("at"), 1000) + 500
    return _envelope(PRICES, price_op() if op is None else op, payload, F.col("event_id"), ts_ms)


def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(_price_envelope(_price_payload()).alias("envelope"))


def cap_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    customer, supply = F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("decimal(20,4)")
    payload = F.struct(
        F.concat(F.lit("a"), customer).alias("asset_id"),
        F.concat(F.lit("s"), customer).alias("symbol"),
        F.concat(F.lit("Coin "), customer).alias("coin_name"),
        F.lit("usd").alias("currency"),
        (supply * 10).cast("string").alias("market_cap"),
        supply.cast("string").alias("circulating_supply"),
        (supply * 2).cast("string").alias("total_supply"),
        F.when(F.col("o_orderpriority") != "1-URGENT", (supply * 3).cast("string")).alias("max_supply"),
        _iso(micros).alias("event_time"),
        _iso(micros + 250_000).alias("source_ts"),
        _iso(micros + 1_000_000).alias("created_at"),
    )
    envelope = _envelope(CAPS, cap_op(), payload, F.col("o_orderkey"), _div(micros, 1000) + 500)
    return table(spark, sf_dir, "orders").select(envelope.alias("envelope"))


def faulty_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prices feed with faults, chosen by the event's own ``k``. The lsn is text here.

    The oracle restates each fault's outcome; see ``FAULT_REASON`` there.
    """
    k, kind = F.col("k"), F.col("event_type")
    payload = _price_payload()
    price = (
        F.when(k == 21, "abc")
        .when(k == 22, "1.2345678901234567891")
        .when(k == 23, "123456789012345678901")
        .when(k == 24, "1.50000000000000000000")
        .when(k == 26, "1E+3")
        .when(k == 27, " 1.5")
        .when(k == 28, "NaN")
        .when(k == 29, "")
        .otherwise(payload["price"])
    )
    time = payload["event_time"]
    changed = (
        payload.withField("price", price)
        .withField("asset_id", F.when(k == 20, "").otherwise(payload["asset_id"]))
        .withField("event_time", F.when(k == 25, F.substring(time, 1, 10)).when(k == 34, F.unix_micros("at").cast("string")).otherwise(time))
    )
    keys_only = F.struct(
        *[
            (payload[f] if f in ("asset_id", "currency", "event_time") else F.lit(None).cast("string")).alias(f)
            for f in envelope_schema(PRICES)["after"].dataType.names
        ]
    )
    image = F.when(k == 32, keys_only).otherwise(changed)
    op = F.when((kind == "signup") & (k < 5), F.lit(None)).when(k == 32, "d").otherwise(price_op())
    envelope = _price_envelope(image, op)
    source = envelope["source"].withField("lsn", F.when(k == 33, F.lit("abc")).when(k != 30, F.col("event_id").cast("string")))
    source = F.when((kind == "purchase") & k.between(5, 9), F.lit(None)).otherwise(source)
    after = F.when((kind == "view") & k.between(10, 14), F.lit(None)).otherwise(envelope["after"])
    broken = F.struct(op.alias("op"), envelope["before"].alias("before"), after.alias("after"), source.alias("source"))
    return events(spark, sf_dir).select(F.when(k != 31, broken).alias("envelope"))


def source_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the source table, with real types."""
    payload = _price_payload()
    names = envelope_schema(PRICES)["after"].dataType.names
    rows = events(spark, sf_dir).select("event_id", "event_type", *[payload[n].alias(n) for n in names])
    amounts = {c: F.col(c).cast("decimal(18,2)") for c in ("market_cap", "volume_24h")}
    times = {c: F.col(c).cast("timestamp") for c in ("event_time", "source_ts", "created_at")}
    return rows.withColumns({"price": F.col("price").cast("decimal(18,8)"), **amounts, **times})


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON pages of at most ten assets, as the remote API would answer.

    A page is ten consecutive events, so no group is larger than a page.
    """
    asset = F.struct(
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("id"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("symbol"),
        F.concat(F.lit("Coin \""), "k", F.lit("\"")).alias("name"),
        F.lit("https://img.example/x.png").alias("image"),
        _iso(F.unix_micros("at")).alias("last_updated"),
        F.col("value").cast("decimal(18,2)").alias("current_price"),
        price_market_cap().alias("market_cap"),
        (F.col("k") + 1).alias("total_volume"),
        F.col("event_id").alias("circulating_supply"),
        (F.col("event_id") * 2).alias("total_supply"),
    )
    return (
        events(spark, sf_dir)
        .select(F.floor(F.col("event_id") / 10).alias("page"), asset.alias("asset"))
        .groupBy("page")
        .agg(F.to_json(F.collect_list("asset")).alias("body"))
    )


def faulty_api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with faults: some cut off, some an error object, and bad prices and names by the event's ``k``."""
    body = F.regexp_replace("body", r'"current_price":[0-9.]+,"market_cap":77000', '"current_price":"n/a","market_cap":77000')
    body = F.regexp_replace(body, r'"name":"Coin \\"12\\"",', "")
    kind = F.pmod(F.col("page"), F.lit(10))
    body = F.when(kind == 3, F.expr("substring(body, 1, length(body) - 5)")).when(kind == 5, '{"error":"rate limit"}').otherwise(body)
    return api_pages(spark, sf_dir).select("page", body.alias("body"))


def landing_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as a drifted second copy: rows lost, repeated and changed, and one hour missing."""
    rows = bronze_prices(spark, sf_dir)
    volume = F.col("volume24h")
    lost = (volume == 14) & (F.col("op") == "c")
    gone = (F.col("ingestion_date") == F.lit("2024-01-27").cast("date")) & (F.col("ingestion_hour") == "05")
    price = F.when((volume == 18) & (F.col("op") == "u"), F.col("price") + 1).otherwise(F.col("price"))
    # All in one pass: filters and a union would read the events again and take their JSON apart for each condition.
    copies = F.when(~lost & ~gone, F.when((volume == 20) & (F.col("op") == "r"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    kept = rows.withColumn("price", price.cast(MONEY)).select("*", F.explode_outer(copies).alias("copy"))
    return kept.filter("copy is not null").drop("copy")


RESET_AT = datetime(2024, 1, 15)


def minute_of(at: str) -> Column:
    return F.floor(F.unix_seconds(at) / 60).cast("bigint")


def topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets per topic and partition at the end of each minute with events.

    Running counts of events; error events go to dead-letter topics. Counting is
    done per minute first, so the running sum sees one row per minute. The
    offsets of one dead-letter topic restart from zero halfway.
    """
    topic = F.when(
        F.col("event_type") == "error", F.lit("bronze.market_prices.dlq")
    ).otherwise(F.concat(F.lit("cdc.public."), "event_type"))
    split = F.when(F.col("k") < 50, 0).otherwise(1)
    era = F.when(F.col("at") < F.lit(RESET_AT.isoformat()).cast("timestamp"), 0).otherwise(1)
    per_minute = (
        events(spark, sf_dir)
        .groupBy(
            topic.alias("topic"),
            split.alias("partition"),
            F.when(F.col("event_type") == "error", era).otherwise(0).alias("era"),
            minute_of("at").alias("minute"),
        )
        .agg(F.count("*").alias("n"))
    )
    timed = chunked(per_minute.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60)), "ts", 86400)
    running = running_total(timed, ["topic", "partition", "era"], "minute", {"current_offset": F.col("n")})
    return running.select("topic", "partition", "ts", "current_offset")


def minute_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every minute from the first event to the last."""
    span = events(spark, sf_dir).agg(F.min(minute_of("at")).alias("a"), F.max(minute_of("at")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("minute"))


def consumer_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced and committed offsets of three consumer groups, each minute.

    A group consumes a topic per event type and leaves large-value events unread.
    Counting is done per minute first, so a series has one row per minute.
    """
    group = (
        F.when(F.col("event_type").isin("signup", "purchase"), "flink-bronze-market-prices")
        .when(F.col("event_type").isin("click", "view"), "flink-bronze-market-caps")
        .otherwise("audit-flink-bronze-copy")
    )
    key = ["consumergroup", "topic"]
    per_minute = (
        events(spark, sf_dir)
        .groupBy(group.alias("consumergroup"), F.col("event_type").alias("topic"), minute_of("at").alias("minute"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("value") < 40).alias("read"))
    )
    span = events(spark, sf_dir).agg(F.min(minute_of("at")).alias("a"), F.max(minute_of("at")).alias("b"))
    series = per_minute.select(*key).distinct().crossJoin(F.broadcast(span))  # one row
    every = series.select(*key, F.explode(F.sequence("a", "b")).alias("minute"))
    timed = every.join(per_minute, [*key, "minute"], "left").withColumn("ts", F.timestamp_seconds(F.col("minute") * 60))
    sums = {"end_offset": F.col("n"), "committed_offset": F.col("read")}
    running = running_total(chunked(timed, "ts", 86400), key, "minute", sums)
    return running.select("ts", *key, F.lit(0).alias("partition"), "end_offset", "committed_offset")


def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the freshness and reconciliation reports would have said each minute.

    A minute's newest event is the last one up to its end, and its copies differ
    while the last minute with events had one of value over 40.
    """
    per_minute = (
        events(spark, sf_dir)
        .groupBy(minute_of("at").alias("minute"))
        .agg(
            F.max(F.when(F.col("event_type") != "error", minute_of("at"))).alias("newest"),
            F.max((F.col("value") > 40).cast("int")).alias("drift"),
        )
    )
    grid = (
        minute_grid(spark, sf_dir)
        .join(per_minute, "minute", "left")
        .select(F.lit("market_prices").alias("table_name"), F.timestamp_seconds(F.col("minute") * 60).alias("checked_at"), "newest", "drift")
    )
    known = carry_forward(
        chunked(grid, "checked_at", 86400),
        ["table_name"],
        "checked_at",
        {"latest": F.col("newest"), "drifted": F.col("drift")},
        inclusive=True,
    )
    lag = minute_of("checked_at") - F.col("latest")
    status = F.when(F.col("drifted") == 1, "MISMATCH").otherwise("HEALTHY")
    return known.select("table_name", "checked_at", lag.alias("minutes_lag"), status.alias("validation_status"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint per event: the job is its type, the duration its value."""
    return events(spark, sf_dir).select(
        F.col("at").alias("ts"),
        F.col("event_type").alias("job_name"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
    )


RULE_HOLDS = (("at-once", 0), ("one-hour", 60), ("two-hours", 120))


def error_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error counts per half hour under three rules; none at all is no data."""
    per_half_hour = (
        events(spark, sf_dir)
        .groupBy(F.floor(F.unix_seconds("at") / 1800).alias("slot"))
        .agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    )
    rule = [F.struct(F.lit(uid).alias("rule_uid"), F.lit(hold).alias("hold_minutes")) for uid, hold in RULE_HOLDS]
    return per_half_hour.select(
        F.timestamp_seconds(F.col("slot") * 1800).alias("ts"),
        F.when(F.col("errors") > 0, F.col("errors").cast("double")).alias("value"),
        F.lit(1.0).alias("threshold"),
        F.explode(F.array(*rule)).alias("rule"),
    ).select("ts", "rule.rule_uid", "value", "threshold", "rule.hold_minutes")
