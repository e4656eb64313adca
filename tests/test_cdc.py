"""Envelopes to bronze rows and dead letters."""

import base64
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.clock import as_instant
from tidemark.operators import cdc
from tidemark.schemas import CAPS, PRICES, bronze_schema, envelope_schema
from tidemark.sources.changes import envelope_from_avro, envelope_from_json, snapshot_envelopes

IMAGE = {
    "asset_id": "bitcoin", "symbol": "btc", "coin_name": "Bitcoin", "currency": "usd", "price": "123.45",
    "market_cap": "1000.50", "volume_24h": None, "coin_image": "x.png", "event_time": "1970-01-01T00:00:01Z",
    "source_ts": "1970-01-01T00:00:02Z", "created_at": "1970-01-01T00:00:03Z",
}
CAP_IMAGE = {
    **{k: IMAGE[k] for k in ("asset_id", "symbol", "coin_name", "currency", "market_cap", "event_time", "created_at")},
    "circulating_supply": "19", "total_supply": "21", "max_supply": None, "source_ts": None,
}
SOURCE = {"db": "m", "schema": "public", "table": "market_prices", "lsn": 42, "ts_ms": 9000}


def envelope(op="c", after=IMAGE, before=None, source=SOURCE, **image):
    changed = {**after, **image} if after is not None else None
    return {"op": op, "before": before, "after": changed, "source": source}


def check(spark, *envelopes, feed=PRICES):
    data = [(e,) for e in envelopes]
    schema = envelope_schema(feed)
    df = spark.createDataFrame(data, f"envelope {schema.simpleString()}")
    return cdc.cdc_validate(df, feed)


def test_a_price_event(spark):
    row = check(spark, envelope()).first()
    assert row.reject_reason is None and row.record is None
    assert (row.assetId, row.symbol, row.coinName, row.currency, row.op, row.lsn) == ("bitcoin", "btc", "Bitcoin", "usd", "c", 42)
    assert (row.eventTimeMs, row.sourceTsMs, row.createdAtMs, row.updatedAtMs) == (1000, 2000, 3000, None)
    assert row.price == Decimal("123.45") and row.volume24h is None


def test_caps_take_the_envelope_clock(spark):
    row = check(spark, envelope(after=CAP_IMAGE), feed=CAPS).first()
    assert row.reject_reason is None and row.sourceTsMs == 9000


@pytest.mark.parametrize(
    ("event", "reason"),
    [
        (None, cdc.UNSUPPORTED),
        (envelope(op=None), cdc.UNSUPPORTED),
        (envelope(op=""), cdc.UNSUPPORTED),
        (envelope(source=None), cdc.UNSUPPORTED),
        (envelope(op="u", after=None), cdc.UNSUPPORTED),
        (envelope(op="d"), cdc.UNSUPPORTED),
        (envelope(symbol=""), "symbol is missing"),
        (envelope(coin_image=None), "coinImage is missing"),
        (envelope(event_time="2024-01-02"), "eventTimeMs is missing"),
        (envelope(created_at=None), "createdAtMs is missing"),
        (envelope(price="1.2345678901234567891"), "price does not fit decimal(38,18)"),
        (envelope(market_cap="123456789012345678901"), "marketCap does not fit decimal(38,18)"),
        (envelope(source={**SOURCE, "table": None}), "sourceTable is missing"),
        (envelope(op="x"), None),
        (envelope(price="abc"), None),
        (envelope(source={**SOURCE, "lsn": None}), None),
    ],
)
def test_reject_reasons(spark, event, reason):
    row = check(spark, event).first()
    assert row.reject_reason == reason
    if event is not None and reason is not None:
        assert json.loads(row.record)["op"] == event["op"]
    if reason is None and event["source"]["lsn"] is None:
        assert row.lsn == 0


def test_a_delete_needs_its_keys_only(spark):
    keys = {**dict.fromkeys(IMAGE), "asset_id": "bitcoin", "currency": "usd", "event_time": IMAGE["event_time"]}
    row = check(spark, envelope(op="d", after=None, before=keys)).first()
    assert row.reject_reason is None
    assert (row.assetId, row.symbol, row.sourceTsMs, row.createdAtMs) == ("bitcoin", None, 9000, 9000)


def test_good_and_rejected_make_the_input(spark):
    events = [envelope(), envelope(op=None), None, envelope(price="x"), envelope(symbol=None)]
    good, bad = cdc.dlq_split(check(spark, *events))
    assert good.count() == 2 and bad.count() == 3


def test_dead_letters_carry_any_text(spark):
    text = 'line\n"quoted"\ttab\\ \x01'
    df = spark.createDataFrame([("bad op", "raw-record"), (text, text), ("r", None)], "reason string, record string")
    letters = [json.loads(r.value) for r in cdc.dlq_format(df).collect()]
    assert letters == [
        {"reason": "bad op", "record": "raw-record"},
        {"reason": text, "record": text},
        {"reason": "r", "record": ""},
    ]


def test_text_that_is_not_json_is_rejected_with_its_text(spark):
    lines = spark.createDataFrame([("{broken",), (json.dumps(envelope()),)], "value string")
    checked = cdc.cdc_validate(envelope_from_json(lines, PRICES), PRICES).collect()
    assert [(r.reject_reason, r.record) for r in checked] == [(cdc.UNSUPPORTED, "{broken"), (None, None)]


def test_rows_to_json(spark):
    row = ('a"quoted"name', "btc", "Bitcoin", "usd", None, Decimal("123.45"), None, "i", 1000, 1, 1, None, "c", 42, "d", "s", "t", None, "07")
    df = spark.createDataFrame([row], bronze_schema(PRICES))
    got = json.loads(cdc.row_to_json(df).first().value, parse_float=Decimal)
    assert got["assetId"] == 'a"quoted"name' and got["lsn"] == 42
    assert got["marketCap"] == Decimal("123.45")
    assert got["price"] is None and "updatedAtMs" in got


def test_the_stamp_is_local_and_two_digits(spark):
    df = spark.range(1)
    row = cdc.stamp(df, as_instant(datetime(2024, 1, 31, 18, 30))).first()
    assert (str(row.ingestion_date), row.ingestion_hour) == ("2024-02-01", "01")


def test_routing_by_table(spark):
    other = envelope(source={**SOURCE, "table": "market_caps"})
    hidden = envelope(source={**SOURCE, "schema": "private"})
    df = spark.createDataFrame([(envelope(),), (other,), (hidden,)], f"envelope {envelope_schema(PRICES).simpleString()}")
    routed = cdc.cdc_route(df, "public", ["market_prices", "market_caps"])
    assert {t: d.count() for t, d in routed.items()} == {"market_prices": 1, "market_caps": 1}


def test_a_snapshot_reads_like_live_events(spark):
    table = spark.createDataFrame(
        [("bitcoin", "btc", "Bitcoin", "usd", Decimal("1.5"), "x.png", datetime(2024, 1, 2, 3, 4, 5, 600000))],
        "asset_id string, symbol string, coin_name string, currency string, price decimal(18,8), coin_image string, event_time timestamp",
    )
    table = table.withColumns({"source_ts": F.col("event_time"), "created_at": F.col("event_time")})
    row = cdc.cdc_parse(snapshot_envelopes(table, PRICES, F.lit(7)), PRICES).first()
    assert (row.op, row.lsn, row.price, row.eventTimeMs) == ("r", 7, Decimal("1.5"), 1704164645600)


def test_json_feeds_reject_what_no_number_can_be(spark):
    """A bad lsn is a reject, and a number as time is microseconds."""
    micros = {**IMAGE, "event_time": 1_704_164_645_123_456, "source_ts": -1_999, "created_at": "1704164645000000"}
    events = [envelope(source={**SOURCE, "lsn": "abc"}), envelope(source={**SOURCE, "lsn": 2**63}), envelope(after=micros), envelope()]
    lines = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    got = cdc.cdc_validate(envelope_from_json(lines, PRICES), PRICES).collect()
    bad = "lsn is not a 64-bit integer"
    assert [r.reject_reason for r in got] == [bad, bad, None, None]
    assert (got[2].eventTimeMs, got[2].sourceTsMs, got[2].createdAtMs) == (1704164645123, -1, 1704164645000)
    assert json.loads(got[0].record)["source"]["lsn"] == "abc" and got[3].lsn == 42


def test_messages_are_decoded_by_the_schema_they_name(spark):
    """The decoder stands in for Avro: the writer's schema is a prefix to take off."""

    def decode(body, writer, reader):
        text = F.decode(body, "UTF-8")
        return F.when(F.startswith(text, F.lit(writer)), F.from_json(F.substring(text, len(writer) + 1, 10_000), envelope_schema(PRICES)))

    event = json.dumps(envelope())
    bodies = [(1, f"A{event}"), (2, f"BB{event}"), (3, f"A{event}"), (2, f"A{event}")]
    frames = [b"\0" + n.to_bytes(4, "big") + text.encode() for n, text in bodies] + [b"\1\0\0\0\1" + event.encode(), b"\0"]
    messages = spark.createDataFrame([(m,) for m in frames], "value binary")
    read = envelope_from_avro(messages, {1: "A", 2: "BB"}, "reader", decode=decode)
    got = cdc.cdc_validate(read, PRICES).collect()
    assert [r.reject_reason for r in got] == [None, None, *[cdc.UNSUPPORTED] * 4]
    assert [base64.b64decode(r.record) for r in got[2:]] == frames[2:]
