"""The workload's feeds and the clock that stamps them."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.clock import ingest_stamp
from workload import feeds

NINE = '{"k": 19}'


@pytest.fixture
def tables(spark, folder):
    """Events with drift by k: 13 and a signup is lost, 17 and a view changed, 19 and a purchase repeated."""
    at = datetime(2024, 1, 5, 3)
    found = [
        (1, at, 7, "signup", 1.0, '{"k": 13}'),
        (2, at, 7, "view", 1.0, '{"k": 17}'),
        (3, at, 7, "purchase", 1.0, NINE),
        (3, at, 7, "purchase", 1.0, NINE),
        (4, datetime(2024, 1, 26, 22, 30), 7, "view", 1.0, '{"k": 1}'),  # 05:30 on the 27th in the local zone
        (5, at, 7, "view", 1.0, None),
        (6, at, 7, "signup", 1.0, "{}"),
        (7, at, None, "purchase", None, ' {"j": [1], "k":19} '),
        (8, None, 7, "view", 1.0, '{"k": 2}'),
        (None, at, 7, "view", 1.0, '{"k": -4}'),
    ]
    frame = spark.createDataFrame(found, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    frame.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "ts" else c for c in frame.columns]).write.parquet(f"{folder}/events.parquet")
    return folder


def test_the_drifted_copy_reads_the_events_once(spark, tables):
    found = feeds.landing_prices(spark, tables)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    got = rows(found.select("lsn", F.col("price").cast("double"), F.col("volume24h").cast("int")))
    want = [(2, 2.0, 18), *[(3, 1.0, 20)] * 4, (5, 1.0, None), (7, None, 20), (7, None, 20), (None, 1.0, -3)]
    # conditions that are null drop a row: the signup without k, and the event without a time on the 27th or not
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_k_as_the_parser_reads_it(spark, folder):
    texts = ['{"k": 76}', '{"k":0}', '{"k": -12}', '{"k": 07}', '{"k": 7} ', '{"j": 1, "k": 8}', '{"k": "9"}', '{"k": null}', "{}", "no", "", None, '{"k": 123456789}']
    frame = spark.createDataFrame([(n, x) for n, x in enumerate(texts)], "event_id long, props string")
    full = frame.select("event_id", F.lit(None).cast("timestamp").alias("ts"), F.lit(1).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), "props")
    full.write.parquet(f"{folder}/events.parquet")
    plain = frame.select("event_id", F.get_json_object("props", "$.k").cast("int"))
    assert rows(feeds.events(spark, folder).select("event_id", "k")) == rows(plain)


def test_the_stamp_does_not_depend_on_the_session_s_zone(spark):
    """02:30 of that night is no hour of New York's clocks, but is one of Jakarta's."""
    micros = [1_710_012_600_000_000, -1, -86_400_000_000 * 40_000 + 5, 0, None]
    frame = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("at"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [tuple(r) for r in frame.select(*ingest_stamp(F.col("at"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == (date(2024, 3, 10), "02")
    assert got[1] == (date(1970, 1, 1), "06") and got[2][1] == "07" and got[3] == (date(1970, 1, 1), "07")
    assert got[4] == (None, None)
