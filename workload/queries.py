"""One query per operator over the driver's tables.

Results use plain types only: decimals, dates and times leave as text, so that
any engine can compare them exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import tables
from tidemark.functions import clock, digest, payload, wire
from tidemark.operators import cdc, ingest, layout, ranking, series, state, subjects
from tidemark.plans import activity, alerts, freshness, gold, overview, reconcile, silver
from tidemark.schemas import CAPS, PRICES, Feed, bronze_schema, envelope_schema
from tidemark.session import configure, stage, work_dir
from tidemark.sources import changes, landing
from tidemark.streaming import alerting, incremental, newest, pipeline, sinks
from workload import feeds

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def plain(df: DataFrame, *columns: str, doubles: int = 6) -> DataFrame:
    """Text for decimals, dates and times; doubles rounded."""
    chosen: list[Column] = []
    for field in df.schema:
        if columns and field.name not in columns:
            continue
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DecimalType, T.DateType)):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DoubleType):
            column = F.round(column, doubles)
        chosen.append(column.alias(field.name))
    return df.select(*chosen)


def event_clock() -> Column:
    """Event time as the batch's time, so results can be repeated."""
    return F.timestamp_millis("eventTimeMs")


def json_feed(spark: SparkSession, rows: DataFrame, feed: Feed, **options) -> DataFrame:
    """Change events written as JSON lines and read back as a stream. Digits that
    stand as text in the envelope's lsn or event time become JSON numbers."""
    path = work_dir(spark, f"{feed.name}-json")
    line = F.regexp_replace(F.to_json("envelope"), r'"(lsn|event_time)":"([0-9]+)"', r'"$1":$2')
    # Dealt out by content, so that one input file is no single task.
    rows.select(line.alias("value")).repartition(F.xxhash64("value")).write.text(path)
    return changes.cdc_stream(spark, feed, path, fmt="json", **options)


def restamped(rows: DataFrame, at: Column) -> DataFrame:
    """Rows with another ingestion clock."""
    return rows.drop("ingestion_date", "ingestion_hour").select("*", *clock.ingest_stamp(at))


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices ingested once a day, at midday."""
    midday = F.date_trunc("day", event_clock()) + F.expr("INTERVAL 12 HOURS")
    return restamped(feeds.bronze_prices(spark, sf_dir), midday)


def without(df: DataFrame, *columns: str) -> DataFrame:
    return plain(cdc.star_except(df, *columns))


# --- sources and scans ------------------------------------------------------


@query
def lz_scan(spark, sf_dir):
    base = work_dir(spark, "landing")
    sinks.lz_sink(daily_prices(spark, sf_dir), base, PRICES, 0)
    return without(landing.lz_scan(spark, base, PRICES), "updatedAtMs")


def _stream_to_table(spark, stream: DataFrame, feed: Feed) -> DataFrame:
    """Run a change stream to its end and return the bronze table it wrote."""
    out = work_dir(spark, f"{feed.name}-bronze")
    pipeline.start_bronze(
        stream, feed, pipeline.Targets(bronze=out), work_dir(spark, "checkpoint"), available_now=True, at=event_clock()
    ).awaitTermination()
    return landing.bronze_scan(spark, out, feed)


@query
def cdc_stream(spark, sf_dir):
    stream = json_feed(spark, feeds.price_changes(spark, sf_dir), PRICES)
    return without(_stream_to_table(spark, stream, PRICES), "updatedAtMs")


@query
def snapshot_then_stream(spark, sf_dir):
    """Purchases are the table as the snapshot found it; the rest arrives live."""
    held = feeds.source_prices(spark, sf_dir).filter("event_type = 'purchase'")
    snapshot = changes.snapshot_envelopes(held, PRICES, F.col("event_id"), feeds.PRICES_AS_OF)
    live = feeds.price_changes(spark, sf_dir).filter("envelope.op <> 'r'")
    out = work_dir(spark, "bronze")
    pipeline.snapshot_then_stream(
        snapshot,
        json_feed(spark, live, PRICES),
        PRICES,
        pipeline.Targets(bronze=out),
        work_dir(spark, "checkpoint"),
        feeds.PRICES_AS_OF,
        available_now=True,
        at=event_clock(),
    ).awaitTermination()
    return without(landing.bronze_scan(spark, out, PRICES), "updatedAtMs")


@query
def cdc_route(spark, sf_dir):
    """One mixed feed of three tables, of which two are captured."""
    as_json = F.to_json("envelope").alias("raw")
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        F.to_json(
            F.struct(
                F.lit("c").alias("op"),
                F.struct(F.lit("public").alias("schema"), F.lit("audit").alias("table"), F.col("l_orderkey").alias("lsn")).alias("source"),
            )
        ).alias("raw")
    )
    path = work_dir(spark, "mixed-feed")
    for part in (
        feeds.price_changes(spark, sf_dir).select(as_json),
        feeds.cap_changes(spark, sf_dir).select(as_json),
        lines,
    ):
        part.write.mode("append").text(path)
    mixed = spark.read.schema("raw string").text(path)
    tagged = mixed.withColumn("envelope", F.from_json("raw", T.StructType([envelope_schema(PRICES)["source"]])))
    routed = cdc.cdc_route(tagged, "public", [PRICES.name, CAPS.name])
    parts = []
    for feed in (PRICES, CAPS):
        rows = cdc.cdc_parse(changes.envelope_from_json(routed[feed.name], feed, "raw"), feed)
        parts.append(rows.groupBy("sourceTable", "op").agg(F.count("*").alias("n"), F.sum("lsn").alias("lsn_sum")))
    return parts[0].unionByName(parts[1])


def _pages(spark, sf_dir):
    loaded = clock.as_instant(feeds.PRICES_AS_OF)
    return ingest.api_page_explode(feeds.api_pages(spark, sf_dir), loaded_at=loaded)


@query
def api_page_explode(spark, sf_dir):
    prices, caps, _ = _pages(spark, sf_dir)
    return plain(
        prices.withColumn("circulating_supply", F.lit(None).cast("decimal(38,18)"))
        .withColumn("kind", F.lit("price"))
        .unionByName(caps.withColumn("kind", F.lit("cap")), allowMissingColumns=True)
        .drop("total_supply", "max_supply")
    )


@query
def api_page_rejects(spark, sf_dir):
    """Pages with faults: what is accepted and what is rejected, by reason; nothing is lost."""
    pages = feeds.faulty_api_pages(spark, sf_dir)
    assets, rejects = ingest.api_assets(pages)
    accepted = assets.select("page", F.lit(None).cast("string").alias("reason"))
    return accepted.unionByName(rejects.select("page", "reason")).groupBy("reason").agg(
        F.count("*").alias("n"), F.sum("page").alias("page_sum")
    )


@query
def bronze_scan(spark, sf_dir):
    path = work_dir(spark, "bronze")
    layout.bronze_layout(feeds.bronze_prices(spark, sf_dir), path)
    return without(landing.bronze_scan(spark, path, PRICES, feeds.PRICES_AS_OF, landing.CHECK_DAYS), "updatedAtMs")


@query
def lz_file_inventory(spark, sf_dir):
    base = work_dir(spark, "landing")
    sinks.lz_sink(daily_prices(spark, sf_dir), base, PRICES, 0)
    files = landing.lz_file_inventory(spark, base, PRICES)
    return plain(files.select("ingestion_date", "hour", (F.col("objects") > 0).alias("held"), (F.col("bytes") > 0).alias("filled")))


# --- row transforms ---------------------------------------------------------


@query
def cdc_parse_prices(spark, sf_dir):
    rows = feeds.price_changes(spark, sf_dir)
    return without(cdc.cdc_parse(rows, PRICES), "updatedAtMs")


@query
def cdc_parse_caps(spark, sf_dir):
    rows = feeds.cap_changes(spark, sf_dir)
    return without(cdc.cdc_parse(rows, CAPS), "updatedAtMs")


@query
def bronze_prices(spark, sf_dir):
    rows = feeds.price_changes(spark, sf_dir)
    return without(cdc.bronze(rows, PRICES, event_clock())[0], "updatedAtMs")


@query
def bronze_caps(spark, sf_dir):
    rows = feeds.cap_changes(spark, sf_dir)
    return without(cdc.bronze(rows, CAPS, event_clock())[0], "updatedAtMs")


def _faulty(spark, sf_dir) -> DataFrame:
    rows = json_feed(spark, feeds.faulty_price_changes(spark, sf_dir), PRICES, streaming=False)
    return cdc.cdc_validate(rows, PRICES)


@query
def cdc_validate(spark, sf_dir):
    checked = _faulty(spark, sf_dir)
    return checked.groupBy("reject_reason").agg(
        F.count("*").alias("n"), F.count("price").alias("priced"), F.count("record").alias("recorded")
    )


@query
def dlq_split(spark, sf_dir):
    accepted, rejected = cdc.dlq_split(_faulty(spark, sf_dir))
    good = accepted.select(
        "lsn", "assetId", "symbol", "op", F.col("price").cast("string").alias("price"), "eventTimeMs", "sourceTsMs", "createdAtMs",
        F.lit(None).cast("string").alias("reason"),
    )
    source = lambda field: F.get_json_object("record", f"$.source.{field}")
    bad = rejected.select(
        source("lsn").try_cast("bigint").alias("lsn"),
        *[F.lit(None).cast("string").alias(c) for c in ("assetId", "symbol")],
        F.get_json_object("record", "$.op").alias("op"),
        F.lit(None).cast("string").alias("price"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("eventTimeMs", "sourceTsMs", "createdAtMs")],
        "reason",
    )
    return good.unionByName(bad)


@query
def dlq_format(spark, sf_dir):
    letters = cdc.dlq_format(cdc.dlq_split(_faulty(spark, sf_dir))[1])
    fields = letters.select(F.from_json("value", "reason string, record string").alias("v"))
    return fields.groupBy(
        F.col("v.reason").alias("reason"),
        (F.col("v.record") == "").alias("blank"),
        F.get_json_object("v.record", "$.after.price").alias("price_text"),
    ).agg(F.count("*").alias("n"))


@query
def ingest_stamp(spark, sf_dir):
    rows = feeds.bronze_prices(spark, sf_dir).select("lsn", "eventTimeMs")
    return plain(cdc.stamp(rows, event_clock()))


@query
def epoch_to_local_time(spark, sf_dir):
    rows = feeds.bronze_prices(spark, sf_dir)
    moment = clock.epoch_to_local_time(F.col("eventTimeMs"))
    return rows.select(
        "lsn",
        F.unix_seconds(moment).alias("event_second"),
        F.date_format(clock.local_clock(moment), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
    )


@query
def local_event_date(spark, sf_dir):
    rows = feeds.bronze_caps(spark, sf_dir).unionByName(feeds.bronze_prices(spark, sf_dir), allowMissingColumns=True)
    millis = F.col("eventTimeMs")
    return plain(
        rows.groupBy(clock.local_event_date(millis).alias("event_date"), clock.event_month(millis).alias("event_month"))
        .agg(F.count("*").alias("n"))
    )


# Text forms to read, chosen by an event's k.
TEXT_CASES = [
    "", "0", "-0", "7", "+7", "-7", "007", "9223372036854775807", "9223372036854775808", "-9223372036854775808",
    " 7", "7 ", "1.5", "1.", ".5", "abc", "NaN", "1e3", "1E+3", "-1.25e-2", "1e400", "0e400", "1e99999999999",
    "123.45", "0.000000000000000001", "0.0000000000000000001", "-987654321.123456789", "1.50000000000000000000",
    "99999999999999999999", "100000000000000000000", "12345678901234567890.123456789012345678",
    "1.2345678901234567891", "0.0000000000000000000", "1e-18", "1e-19", "10e-19", "--1", "1,5", "Infinity", "\t1",
    "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+07:00", "2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05.9999Z",
    "2024-01-02T03:04Z", "2024-01-02t03:04:05z", "2024-01-02", "2024-01-02T03:04:05", "2024-02-30T00:00:00Z",
    "2024-01-02 03:04:05Z", "1969-12-31T23:59:59.9995Z", "2024-01-02T03:04:05-03", "2024-01-02T25:00:00Z",
]


def _texts(spark, sf_dir) -> DataFrame:
    """Each event with a case text, or for the rest of the k values its own value as text."""
    cases = F.array(*[F.lit(t) for t in TEXT_CASES])
    own = F.col("value").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("k") < len(TEXT_CASES), F.get(cases, F.col("k"))).otherwise(own)
    return feeds.events(spark, sf_dir).select("event_id", "k", text.alias("text"))


@query
def text_or_null(spark, sf_dir):
    return _texts(spark, sf_dir).select("event_id", payload.text_or_null(F.col("text")).alias("text"))


@query
def long_or_null(spark, sf_dir):
    text = F.col("text")
    return _texts(spark, sf_dir).select("event_id", payload.long_or_null(text).alias("number"), payload.long_unfit(text).alias("unfit"))


@query
def decimal_or_null(spark, sf_dir):
    return plain(_texts(spark, sf_dir).select("event_id", payload.decimal_or_null(F.col("text")).alias("amount")))


@query
def decimal_38_18_exact(spark, sf_dir):
    reading = payload.decimal_reading(F.col("text"))
    return plain(
        _texts(spark, sf_dir).select("event_id", reading.alias("r"))
        .select("event_id", F.col("r.number").alias("amount"), F.coalesce("r.unfit", F.lit(False)).alias("unfit"))
    )


@query
def ts_to_millis(spark, sf_dir):
    iso = _texts(spark, sf_dir).select("event_id", payload.iso_to_millis(F.col("text")).alias("millis"), F.lit("iso").alias("form"))
    micros = feeds.events(spark, sf_dir).select(
        "event_id",
        payload.ts_to_millis(F.unix_micros("at") - F.lit(1704067200000000 + 86400000000 * 15), T.LongType()).alias("millis"),
        F.lit("micros").alias("form"),
    )
    return iso.unionByName(micros)


@query
def row_to_json(spark, sf_dir):
    rows = cdc.row_to_json(feeds.bronze_prices(spark, sf_dir))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return rows.select(
        field("lsn").cast("bigint").alias("lsn"),
        field("assetId").alias("asset"),
        field("coinName").alias("coin"),
        field("price").cast("decimal(38,18)").cast("string").alias("price"),
        field("marketCap").cast("decimal(38,18)").cast("string").alias("cap"),
        F.array_contains(F.json_object_keys("value"), "marketCap").alias("has_cap"),
        F.array_contains(F.json_object_keys("value"), "updatedAtMs").alias("has_updated"),
        field("ingestion_date").alias("day"),
    )


@query
def not_deleted(spark, sf_dir):
    """Delete events dropped from history, beside assets dropped when last seen deleted."""
    rows = feeds.bronze_prices(spark, sf_dir)
    history = cdc.not_deleted(rows).groupBy("assetId").agg(F.count("*").alias("events"))
    return history.join(
        cdc.not_deleted(silver.latest_state(rows, PRICES)).select("assetId", F.lit(True).alias("live")), "assetId", "left"
    ).select("assetId", "events", F.coalesce("live", F.lit(False)).alias("live"))


@query
def star_except(spark, sf_dir):
    return plain(cdc.star_except(feeds.bronze_caps(spark, sf_dir), "updatedAtMs", "sourceDb", "sourceSchema"))


@query
def confluent_header(spark, sf_dir):
    """Framed messages: the schema id is the event type's length, and errors have a bad magic byte."""
    whole = wire.frame(F.encode("event_type", "UTF-8"), F.length("event_type") + 70000)
    damaged = F.when(F.col("event_type") == "error", F.overlay(whole, F.unhex(F.lit("01")), F.lit(1))).otherwise(whole)
    framed = F.when(F.col("k") == 7, F.substring(damaged, 1, 1)).otherwise(damaged)
    messages = feeds.events(spark, sf_dir).select(framed.alias("value"))
    return (
        messages.select(*wire.confluent_header(F.col("value")))
        .groupBy("magic", "schema_id", F.decode("body", "UTF-8").alias("body"))
        .agg(F.count("*").alias("n"))
    )


@query
def subject_set_check(spark, sf_dir):
    """Fields each asset used in the first half of the month against the second."""
    used = feeds.events(spark, sf_dir).withColumn("late", F.col("at") >= F.lit("2024-01-16").cast("timestamp"))
    kind = F.when(F.max("k") >= 95, "decimal").otherwise("int")
    fields = used.groupBy(
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("subject"), F.col("event_type").alias("field"), "late"
    ).agg(kind.alias("type"))
    return subjects.subject_set_check(fields.filter("not late"), fields.filter("late"))


# --- insert rules, sinks, retention -----------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def _lines(spark, sf_dir) -> DataFrame:
    return feeds.table(spark, sf_dir, "lineitem")


def _arriving(spark, sf_dir):
    """Open lines arrive at a table that holds the finished ones."""
    lines = _lines(spark, sf_dir)
    return lines.filter("l_linestatus = 'O'"), lines.filter("l_linestatus = 'F'")


@query
def insert_ignore(spark, sf_dir):
    batch, target = _arriving(spark, sf_dir)
    return plain(ingest.insert_ignore(batch, target, LINE_KEY, ["l_shipdate"], within="l_orderkey"))


@query
def anti_existing(spark, sf_dir):
    batch, target = _arriving(spark, sf_dir)
    return plain(ingest.anti_existing(batch, target, LINE_KEY))


BATCH_TIMES = (datetime(2024, 1, 31, 15), datetime(2024, 1, 31, 18))


def _in_two_batches(rows: DataFrame, write) -> None:
    """Deletes and updates as batch 1, the rest as batch 0, and batch 1 once more.

    Each batch has its own ingestion time, on either side of local midnight.
    """
    changed = F.col("op").isin("d", "u")
    first, second = (clock.as_instant(at) for at in BATCH_TIMES)
    write(restamped(rows.filter(~changed), first), 0)
    write(restamped(rows.filter(changed), second), 1)
    write(restamped(rows.filter(changed), second), 1)


@query
def lz_sink(spark, sf_dir):
    base = work_dir(spark, "landing")
    _in_two_batches(feeds.bronze_prices(spark, sf_dir), lambda rows, n: sinks.lz_sink(rows, base, PRICES, n))
    return without(landing.lz_scan(spark, base, PRICES), "updatedAtMs")


@query
def bronze_sink(spark, sf_dir):
    path = work_dir(spark, "bronze")
    _in_two_batches(feeds.bronze_caps(spark, sf_dir), lambda rows, n: sinks.bronze_sink(rows, path, CAPS, n))
    return without(landing.bronze_scan(spark, path, CAPS), "updatedAtMs")


@query
def kafka_sink(spark, sf_dir):
    """Messages go to files here; a broker target differs by its options only."""
    path = work_dir(spark, "topic")
    _in_two_batches(feeds.bronze_prices(spark, sf_dir), lambda rows, n: sinks.kafka_sink(rows, {"path": path}, n))
    body = F.from_json("value", bronze_schema(PRICES)).alias("v")
    return plain(spark.read.schema("value string").text(path).select(body).select("v.*"))


@query
def fan_out(spark, sf_dir):
    """The faulty feed through the whole streaming job; what each target received."""
    base = work_dir(spark, "fan-out")
    targets = pipeline.Targets(
        landing=f"{base}/lz", bronze=f"{base}/bronze", topic={"path": f"{base}/topic"}, dead_letters={"path": f"{base}/dlq"}
    )
    stream = json_feed(spark, feeds.faulty_price_changes(spark, sf_dir), PRICES)
    pipeline.start_bronze(stream, PRICES, targets, f"{base}/checkpoint", available_now=True).awaitTermination()

    def received(name: str, rows: DataFrame, lsn: Column) -> DataFrame:
        return rows.agg(F.count("*").alias("n"), F.sum(lsn).alias("lsn_sum")).select(F.lit(name).alias("target"), "n", "lsn_sum")

    message = lambda path: F.get_json_object("value", path).cast("bigint")
    text = lambda path: spark.read.schema("value string").text(path)
    letter = F.get_json_object(F.get_json_object("value", "$.record"), "$.source.lsn").try_cast("bigint")
    return (
        received("landing", landing.lz_scan(spark, f"{base}/lz", PRICES), F.col("lsn"))
        .unionByName(received("bronze", landing.bronze_scan(spark, f"{base}/bronze", PRICES), F.col("lsn")))
        .unionByName(received("topic", text(f"{base}/topic"), message("$.lsn")))
        .unionByName(received("dead_letters", text(f"{base}/dlq"), letter))
    )


@query
def constraint_check(spark, sf_dir):
    rules = ingest.TableRules(
        required=("l_orderkey", "l_linenumber", "l_shipdate"),
        numeric=(("l_extendedprice", 6, 2), ("l_quantity", 4, 2)),
        key=tuple(LINE_KEY),
    )
    lines = _lines(spark, sf_dir)
    amounts = {c: F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_quantity")}
    checked = ingest.constraint_check(lines.withColumns(amounts), rules)
    return checked.groupBy("violation").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))


RETENTION_AS_OF = datetime(2001, 6, 30, 20)


@query
def compact_days(spark, sf_dir):
    """Bronze written in two batches, compacted in place between them and after; what its log then counts."""
    path = work_dir(spark, "bronze")

    def write(rows, number):
        sinks.bronze_sink(rows, path, CAPS, number)
        tables.compact_days(spark, path, CAPS, bronze_schema(CAPS))
        tables.roll(spark, path)
        tables.vacuum(spark, path)

    _in_two_batches(feeds.bronze_caps(spark, sf_dir), write)
    return without(landing.bronze_scan(spark, path, CAPS), "updatedAtMs")


@query
def retention(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("day", F.to_date("l_shipdate"))
    kept = layout.retention(lines, RETENTION_AS_OF, "day")
    return plain(kept.select("l_orderkey", "l_linenumber", "l_partkey", "day"))


@query
def bronze_layout(spark, sf_dir):
    path = work_dir(spark, "bronze")
    layout.bronze_layout(feeds.bronze_prices(spark, sf_dir), path)
    return without(landing.bronze_scan(spark, path, PRICES), "updatedAtMs")


# --- aggregations and state -------------------------------------------------


@query
def latest_state_prices(spark, sf_dir):
    return plain(silver.latest_state(feeds.bronze_prices(spark, sf_dir), PRICES))


@query
def latest_state_caps(spark, sf_dir):
    return plain(silver.latest_state(feeds.bronze_caps(spark, sf_dir), CAPS))


@query
def silver_prices(spark, sf_dir):
    return plain(silver.silver_prices(feeds.bronze_prices(spark, sf_dir)))


@query
def silver_caps(spark, sf_dir):
    return plain(silver.silver_caps(feeds.bronze_caps(spark, sf_dir)))


@query
def state_merge(spark, sf_dir):
    """Partial states by kind of change, one of them merged twice."""
    rows = feeds.bronze_prices(spark, sf_dir)
    parts = [silver.latest_state(rows.filter(F.col("op") == op), PRICES) for op in ("c", "r", "u", "d")]
    return plain(state.state_merge(*parts, parts[0]))


@query
def latest_state_stream(spark, sf_dir):
    """Bronze files as a stream."""
    source, path = work_dir(spark, "bronze"), work_dir(spark, "state")
    rows = feeds.bronze_prices(spark, sf_dir)
    layout.bronze_layout(rows, source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    incremental.latest_state_stream(
        stream, silver.state_payload(PRICES), path, work_dir(spark, "checkpoint"), available_now=True
    ).awaitTermination()
    shape = rows.select(*state.STATE_KEYS, *state.STATE_VERSION, *silver.state_payload(PRICES)).schema
    return plain(incremental.read_state(spark, path, shape))


@query
def replacing_dedup(spark, sf_dir):
    return plain(state.replacing_dedup(_lines(spark, sf_dir), LINE_KEY, "l_shipdate"))


@query
def latest_nonnull_by_time(spark, sf_dir):
    rows = feeds.bronze_caps(spark, sf_dir)
    values = ["circulatingSupply", "totalSupply", "maxSupply"]
    return plain(state.latest_nonnull_by_time(rows, ["assetId"], values, ["eventTimeMs", "lsn"]))


@query
def basic_aggs(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return plain(
        _lines(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(
            F.count("*").alias("n"),
            F.min("l_orderkey").alias("min_key"),
            F.max("l_orderkey").alias("max_key"),
            F.max("l_shipdate").alias("last_ship"),
            F.sum(price).cast("decimal(38,2)").alias("price_sum"),
        )
    )


@query
def count_if(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_linenumber").agg(
        F.count_if(F.col("l_returnflag") != "N").alias("returned"), F.count_if(F.col("l_tax") > 0.04).alias("taxed")
    )


@query
def table_checksum(spark, sf_dir):
    """Checksums another engine can recompute, and what Spark's own hash says of an equal and of a drifted copy."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", price.alias("price"))
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "price"]
    by = ["l_linestatus"]
    portable = reconcile.table_checksum(lines, columns, by, digest.portable_hash)
    copies = {"copy": lines.repartition("l_orderkey"), "drift": lines.withColumn("price", F.when(F.col("l_linenumber") != 1, F.col("price")))}
    own = reconcile.table_checksum(lines, columns, by).select(*by, F.col("checksum").alias("own"))
    for name, rows in copies.items():
        other = reconcile.table_checksum(rows, columns, by).select(*by, F.col("checksum").alias("other"))
        own = own.join(other, by).withColumn(f"{name}_agrees", F.col("own") == F.col("other")).drop("other")
    return plain(portable.withColumn("checksum", F.col("checksum").cast("decimal(38,0)")).join(own.drop("own"), by))


# --- joins ------------------------------------------------------------------


def _facts(spark, sf_dir):
    return (
        gold.fct_market_prices(feeds.bronze_prices(spark, sf_dir), feeds.PRICES_AS_OF),
        gold.fct_market_caps(feeds.bronze_caps(spark, sf_dir), feeds.PRICES_AS_OF),
    )


@query
def left_equi(spark, sf_dir):
    prices, caps = _facts(spark, sf_dir)
    return plain(overview.left_equi(overview.latest_prices(prices), overview.latest_caps(caps)))


@query
def cross_1x1(spark, sf_dir):
    prices = reconcile.side_summary(feeds.bronze_prices(spark, sf_dir), PRICES, "p").drop("p_checksum")
    caps = reconcile.side_summary(feeds.bronze_caps(spark, sf_dir), CAPS, "c").drop("c_checksum")
    return prices.crossJoin(F.broadcast(caps))


@query
def full_outer_equi(spark, sf_dir):
    """Ship days against order days, counted first."""
    shipped = _lines(spark, sf_dir).groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("shipped"))
    ordered = feeds.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("ordered"))
    return plain(shipped.join(ordered, ["day"], "full"))


# --- windows ----------------------------------------------------------------


def _latest(spark, sf_dir) -> DataFrame:
    return overview.latest_prices(_facts(spark, sf_dir)[0])


@query
def global_total(spark, sf_dir):
    totalled = ranking.global_total(stage(_latest(spark, sf_dir), "latest"), {"whole": "market_cap"})
    return plain(totalled.select("asset_id", "market_cap", "whole"))


@query
def market_cap_rank(spark, sf_dir):
    return plain(ranking.market_cap_rank(stage(_latest(spark, sf_dir), "latest")).select("asset_id", "market_cap", "market_cap_rank"))


@query
def market_cap_rank_ranges(spark, sf_dir):
    """Events ranked by value."""
    rows = stage(feeds.table(spark, sf_dir, "events").select("event_id", "value"), "events")
    return ranking.market_cap_rank(rows, "value", "value_rank")


@query
def share_of_total(spark, sf_dir):
    rows = ranking.share_of_total(_latest(spark, sf_dir), "volume_24h", "market_cap", "liquidity")
    return plain(rows.select("asset_id", "liquidity"))


@query
def top_k_assets(spark, sf_dir):
    return plain(ranking.top_k_assets(_latest(spark, sf_dir).select("asset_id", "market_cap"), 10))


@query
def counter_increase(spark, sf_dir):
    rows = series.counter_increase(feeds.topic_offsets(spark, sf_dir), alerts.DLQ_PATTERN, 10)
    return plain(rows)


@query
def counter_rate(spark, sf_dir):
    return plain(series.counter_rate(feeds.topic_offsets(spark, sf_dir), r"cdc\.public\..*"))


@query
def alert_hold(spark, sf_dir):
    rows = series.alert_hold(feeds.error_evaluations(spark, sf_dir), every_minutes=30)
    return plain(rows.select("ts", "rule_uid", "value", "since", "state"))


# --- sets, sorts ------------------------------------------------------------


def _daily(spark, sf_dir, feed: Feed) -> DataFrame:
    rows = feeds.bronze_prices(spark, sf_dir) if feed is PRICES else feeds.bronze_caps(spark, sf_dir)
    return rows.groupBy(F.col("ingestion_date").alias("day")).agg(F.count("*").alias("n")).withColumn("src", F.lit(feed.name))


def union_days(spark, sf_dir) -> DataFrame:
    return _daily(spark, sf_dir, PRICES).unionByName(_daily(spark, sf_dir, CAPS))


@query
def union_all(spark, sf_dir):
    return plain(union_days(spark, sf_dir))


@query
def order_by(spark, sf_dir):
    """Both feeds' days in order."""
    return plain(union_days(spark, sf_dir).orderBy("day", "src"))


# --- composite results ------------------------------------------------------


@query
def dim_asset(spark, sf_dir):
    return plain(gold.dim_asset(feeds.bronze_prices(spark, sf_dir), feeds.PRICES_AS_OF).drop("updated_at"))


@query
def fct_market_prices(spark, sf_dir):
    return plain(_facts(spark, sf_dir)[0].drop("loaded_at"))


@query
def fct_market_caps(spark, sf_dir):
    return plain(_facts(spark, sf_dir)[1].drop("loaded_at"))


@query
def market_overview(spark, sf_dir):
    return plain(overview.market_overview(*_facts(spark, sf_dir)))


def _health(spark, sf_dir, as_of=feeds.PRICES_AS_OF) -> DataFrame:
    return freshness.pipeline_health(
        {
            "market_prices": gold.fact_rows(feeds.bronze_prices(spark, sf_dir), PRICES),
            "market_caps": gold.fact_rows(feeds.bronze_caps(spark, sf_dir), CAPS),
        },
        as_of,
    )


@query
def pipeline_health(spark, sf_dir):
    return plain(_health(spark, sf_dir))


@query
def pipeline_health_noted(spark, sf_dir):
    """Facts written by streams over bronze; their health by the newest events noted on the way."""
    noted = {}
    for feed, rows in ((PRICES, feeds.bronze_prices(spark, sf_dir)), (CAPS, feeds.bronze_caps(spark, sf_dir))):
        base = work_dir(spark, "noted")
        rows.write.parquet(f"{base}/bronze")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/bronze")
        incremental.fact_stream(stream, feed, f"{base}/fct", f"{base}/checkpoint", available_now=True).awaitTermination()
        newest.fold(spark, f"{base}/fct")
        noted[feed.name] = newest.read(spark, f"{base}/fct")
    return plain(freshness.pipeline_health(noted, feeds.PRICES_AS_OF))


@query
def pipeline_status(spark, sf_dir):
    """Worst status as of the end of the prices feed, long before it, and of prices alone 20 minutes after their last."""
    newest = feeds.events(spark, sf_dir).filter("event_type <> 'error'").agg(F.max("at")).first()[0]
    prices = {"market_prices": gold.fact_rows(feeds.bronze_prices(spark, sf_dir), PRICES)}
    late = freshness.pipeline_status(freshness.pipeline_health(prices, F.lit(newest) + F.expr("INTERVAL 20 MINUTES")))
    early = freshness.pipeline_status(_health(spark, sf_dir, datetime(1995, 1, 1)))
    return freshness.pipeline_status(_health(spark, sf_dir)).select(F.lit("end").alias("at"), "status").unionByName(
        early.select(F.lit("start").alias("at"), "status")
    ).unionByName(late.select(F.lit("late").alias("at"), "status"))


@query
def pipeline_lag_max(spark, sf_dir):
    return freshness.pipeline_lag_max(_health(spark, sf_dir))


def _validation(spark, sf_dir) -> DataFrame:
    caps = feeds.bronze_caps(spark, sf_dir)
    prices, drifted = feeds.bronze_prices(spark, sf_dir), feeds.landing_prices(spark, sf_dir)
    return reconcile.sink_validation(prices, drifted, PRICES, feeds.PRICES_AS_OF).unionByName(
        reconcile.sink_validation(caps, caps, CAPS, feeds.CAPS_AS_OF)
    )


@query
def sink_validation(spark, sf_dir):
    return plain(_validation(spark, sf_dir).drop("bronze_checksum", "lz_checksum"))


@query
def sink_validation_partition(spark, sf_dir):
    """Every partition of both feeds, not only the trailing days."""
    caps = feeds.bronze_caps(spark, sf_dir)
    prices, drifted = feeds.bronze_prices(spark, sf_dir), feeds.landing_prices(spark, sf_dir)
    report = reconcile.sink_validation_partition(prices, drifted, PRICES, feeds.PRICES_AS_OF, days=None).unionByName(
        reconcile.sink_validation_partition(caps, caps, CAPS, feeds.CAPS_AS_OF, days=None)
    )
    return plain(report.drop("bronze_checksum", "lz_checksum"))


def _logged_copies(spark, sf_dir) -> list:
    """Both feeds written as bronze and landing tables, in batches, one of them twice: entries of the logs.

    Prices are ingested every six hours, and landing lacks one of them; caps once a month.
    """
    quarter_day = lambda rows: rows.withColumn("ingestion_hour", F.lpad((F.floor(F.col("ingestion_hour").cast("int") / 6) * 6).cast("string"), 2, "0"))
    caps = restamped(feeds.bronze_caps(spark, sf_dir), F.date_trunc("month", event_clock()))
    gone = (F.col("ingestion_date") == F.lit("2024-01-28").cast("date")) & (F.col("ingestion_hour") == "06")
    drifted = quarter_day(feeds.landing_prices(spark, sf_dir)).filter(~gone)
    copies = [
        (PRICES, quarter_day(feeds.bronze_prices(spark, sf_dir)), drifted, feeds.PRICES_AS_OF),
        (CAPS, caps, caps, feeds.CAPS_AS_OF),
    ]
    late = F.col("lsn") % 3 == 0

    def write(sink, rows, path, feed):
        for batch, part in ((0, ~late), (1, late), (1, late)):
            # dealt out by partition, as few files hold each hour then
            sink(rows.filter(part).hint("rebalance", "ingestion_date", "ingestion_hour"), path, feed, batch)

    bases = [work_dir(spark, "copies") for _ in copies]
    # the four tables are written side by side, each batch after batch
    with ThreadPoolExecutor(2 * len(copies)) as pool:
        runs = []
        for base, (feed, bronze_rows, landing_rows, _) in zip(bases, copies):
            runs.append(pool.submit(inheritable_thread_target(spark)(write), sinks.bronze_sink, bronze_rows, f"{base}/bronze", feed))
            runs.append(pool.submit(inheritable_thread_target(spark)(write), sinks.lz_sink, landing_rows, f"{base}/lz", feed))
        for run in runs:
            run.result()
    return [
        (tables.entries(spark, f"{base}/bronze"), tables.entries(spark, landing.landing_path(f"{base}/lz", feed)), feed, as_of)
        for base, (feed, _, _, as_of) in zip(bases, copies)
    ]


@query
def sink_validation_logged(spark, sf_dir):
    """The comparison from the summaries in the two tables' logs."""
    logged = {"summary": reconcile.logged_summary}
    first, second = (reconcile.sink_validation(*copy, **logged) for copy in _logged_copies(spark, sf_dir))
    return plain(first.unionByName(second).drop("bronze_checksum", "lz_checksum"))


@query
def sink_validation_partition_logged(spark, sf_dir):
    logged = {"summary": reconcile.logged_summary, "days": None}
    first, second = (reconcile.sink_validation_partition(*copy, **logged) for copy in _logged_copies(spark, sf_dir))
    return plain(first.unionByName(second).drop("bronze_checksum", "lz_checksum"))


@query
def validation_failures(spark, sf_dir):
    return reconcile.validation_failures(_validation(spark, sf_dir))


@query
def validation_panel(spark, sf_dir):
    return reconcile.validation_panel(_validation(spark, sf_dir))


@query
def bronze_insert_rate(spark, sf_dir):
    tables = {"market_prices": feeds.bronze_prices(spark, sf_dir), "market_caps": feeds.bronze_caps(spark, sf_dir)}
    return plain(activity.bronze_insert_rate(tables, feeds.PRICES_AS_OF, hours=None))


@query
def row_counts(spark, sf_dir):
    prices, caps = feeds.bronze_prices(spark, sf_dir), feeds.bronze_caps(spark, sf_dir)
    return activity.row_counts(
        {
            "bronze.market_prices": (prices, ()),
            "bronze.market_caps": (caps, ()),
            "gold.fct_market_prices": (gold.fact_rows(prices, PRICES), gold.FACT_KEY),
            "gold.fct_market_caps": (gold.fact_rows(caps, CAPS), gold.FACT_KEY),
        }
    )


@query
def consumer_lag(spark, sf_dir):
    return plain(activity.consumer_lag(feeds.consumer_offsets(spark, sf_dir)))


@query
def checkpoint_duration(spark, sf_dir):
    return activity.checkpoint_duration(feeds.checkpoints(spark, sf_dir))


@query
def checkpoint_duration_max(spark, sf_dir):
    return activity.checkpoint_duration_max(feeds.checkpoints(spark, sf_dir))


def _histories(spark, sf_dir) -> dict[str, DataFrame]:
    checks = stage(feeds.check_history(spark, sf_dir), "checks")
    return {
        "health_history": checks,
        "validation_history": checks,
        "topic_offsets": feeds.topic_offsets(spark, sf_dir),
        "consumer_offsets": feeds.consumer_offsets(spark, sf_dir),
    }


@query
def alerts_all(spark, sf_dir):
    states = alerts.alerts(**_histories(spark, sf_dir))
    return plain(states.select("ts", "rule_uid", "value", "since", "state"))


@query
def alerts_carried(spark, sf_dir):
    """The same evaluations, settled ten days at a time by what is held of the days before."""
    found = stage(alerts.rule_evaluations(**_histories(spark, sf_dir)), "evaluations")
    step = F.floor(F.unix_seconds("ts") / (10 * 86400))
    path = work_dir(spark, "alerts")
    first, last = found.agg(F.min(step), F.max(step)).first()
    for number in range(first, last + 1):
        alerting.advance(found.where(step == number), path, number)
    return plain(alerting.states(spark, path).select("ts", "rule_uid", "value", "since", "state"))


REGISTRY["alerts"] = REGISTRY.pop("alerts_all")
