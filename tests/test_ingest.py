"""API pages, first write wins, constraints, subjects, storage layout."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.clock import as_instant
from tidemark.functions.wire import confluent_header, frame
from tidemark.operators import ingest, layout, subjects


def test_a_page_gives_a_price_and_a_cap_per_asset(spark):
    asset = {"id": "btc", "symbol": "b", "name": "B", "image": "i", "last_updated": "2024-01-02T03:04:05.123Z",
             "current_price": 0.1, "market_cap": 12345678901234.56, "total_supply": 21}
    pages = spark.createDataFrame([(1, json.dumps([asset, {**asset, "id": "eth"}])), (2, "[]")], "page int, body string")
    prices, caps, rejects = ingest.api_page_explode(pages, loaded_at=as_instant(datetime(2024, 1, 3)))
    assert prices.count() == caps.count() == 2 and rejects.count() == 0
    price, cap = prices.filter("asset_id = 'btc'").first(), caps.filter("asset_id = 'eth'").first()
    assert (price.price, price.currency, price.volume_24h) == (Decimal("0.1"), "usd", None)
    assert price.event_time == datetime(2024, 1, 2, 3, 4, 5, 123000)
    assert (cap.market_cap, cap.total_supply, cap.max_supply) == (Decimal("12345678901234.56"), Decimal(21), None)


def test_bad_pages_and_assets_are_rejected_not_lost(spark):
    asset = {"id": "btc", "symbol": "b", "name": "B", "image": "i", "last_updated": "2024-01-02T03:04:05Z", "current_price": 1}
    bodies = [json.dumps([asset])[:-4], '{"error": "limit"}', None, json.dumps([asset, {**asset, "current_price": "x"}, {**asset, "name": None}])]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    assets, rejects = ingest.api_assets(pages)
    whole = "page is not a JSON array"
    assert rows(rejects.select("page", "reason")) == [(0, whole), (1, whole), (2, whole), (3, "current_price is no decimal(38,18)"), (3, "name is missing")]
    assert assets.count() == 1


def test_page_rows_meet_the_table_rules(spark):
    asset = {"id": "btc", "symbol": "b", "name": "B", "image": "i", "last_updated": "2024-01-02T03:04:05Z", "current_price": 1}
    page = json.dumps([asset, {**asset, "symbol": "late"}, {**asset, "id": "big", "current_price": 12345678901}, {**asset, "id": "old"}])
    prices, _, _ = ingest.api_page_explode(spark.createDataFrame([(1, page)], "page int, body string"), loaded_at=as_instant(datetime(2024, 1, 3)))
    held = prices.filter("asset_id = 'old'")
    added, refused = ingest.page_inserts(prices, held, ingest.PRICE_RULES, as_instant(datetime(2024, 1, 3)))
    assert [r.asset_id for r in added.collect()] == ["btc"]
    assert rows(refused.select("asset_id", "violation")) == [("big", "price exceeds numeric(18,8)")]


def test_absent_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="price"):
        ingest.constraint_check(spark.range(1).withColumnRenamed("id", "asset_id"), ingest.PRICE_RULES)


def test_the_first_write_wins(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9, 0), ("b", 3, 2), ("b", 2, 1), ("b", 1, 1)], "k string, v int, n int")
    assert rows(ingest.insert_ignore(batch, target, ["k"], ["n"])) == [("b", 1, 1)]


def test_constraints(spark):
    rules = ingest.TableRules(required=("k",), numeric=(("v", 6, 2),), key=("k",))
    data = [("a", "9999.99"), ("b", "9999.995"), (None, "1"), ("c", "1"), ("c", "2"), ("d", None), ("e", "-10000")]
    df = spark.createDataFrame([(k, v and Decimal(v)) for k, v in data], "k string, v decimal(38,18)")
    got = {(r.k, None if r.v is None else str(r.v.normalize())): r.violation for r in ingest.constraint_check(df, rules).collect()}
    duplicate = "duplicate key (k)"
    assert got == {
        ("a", "9999.99"): None, ("b", "9999.995"): "v exceeds numeric(6,2)", (None, "1"): "k is null",
        ("c", "1"): duplicate, ("c", "2"): duplicate, ("d", None): None, ("e", "-1E+4"): "v exceeds numeric(6,2)",
    }


def test_market_rules_name_real_columns(spark):
    assert set(ingest.PRICE_RULES.key) <= set(ingest.PRICE_RULES.required)
    assert dict((c, (p, s)) for c, p, s in ingest.CAP_RULES.numeric)["max_supply"] == (20, 4)


def test_subject_sets(spark):
    shape = "subject string, field string, type string"
    declared = spark.createDataFrame([("t", "a", "int"), ("t", "b", "int"), ("t", "c", "int")], shape)
    used = spark.createDataFrame([("t", "a", "int"), ("t", "b", "string"), ("t", "z", "int")], shape)
    got = rows(subjects.subject_set_check(declared, used).select("field", "status", "failed"))
    assert got == [("a", "same", False), ("b", "changed", True), ("c", "missing", True), ("z", "extra", False)]
    assert rows(subjects.table_fields(declared.limit(0), "s")) == [(("s"), f, "string") for f in ("field", "subject", "type")]


def test_wire_headers(spark):
    values = [b"\x00\x00\x01\x11\x70body", b"\x01\x00\x00\x00\x07x", b"\x00\x00", b"", None, b"\x00\x00\x00\x00\x05"]
    df = spark.createDataFrame([(v,) for v in values], "value binary")
    got = [tuple(r) for r in df.select(*confluent_header(F.col("value"))).collect()]
    assert [(m, s, None if b is None else bytes(b)) for m, s, b in got] == [
        (0, 70000, b"body"), (1, None, None), (0, None, None), (None, None, None), (None, None, None), (0, 5, b""),
    ]


def dated(spark, *days):
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "ingestion_date date, n int")


def test_retention_by_whole_months(spark):
    as_of = datetime(2025, 2, 27, 18)  # 28 February in the local zone
    df = dated(spark, date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1))
    assert [r[0] for r in layout.retention(df, as_of).collect()] == [date(2024, 3, 1)]
    assert layout.expired_partitions(df, as_of).count() == 2


def test_expired_folders_are_deleted(spark, folder):
    path = f"{folder}/t"
    dated(spark, date(2023, 1, 1), date(2024, 6, 1)).write.partitionBy("ingestion_date").parquet(path)
    table = spark.read.schema("n int, ingestion_date date").parquet(path)
    assert layout.drop_expired(table, path, datetime(2024, 7, 1)) == [f"{path}/ingestion_date=2023-01-01"]
    assert spark.read.parquet(path).count() == 1


def test_a_framed_body_reads_back(spark):
    df = spark.createDataFrame([(b"body",)], "b binary").select(frame(F.col("b"), 70000).alias("value"))
    [(magic, schema_id, body)] = df.select(*confluent_header(F.col("value"))).collect()
    assert (magic, schema_id, bytes(body)) == (0, 70000, b"body")


def test_the_inventory_counts_empty_files(spark, folder):
    path = f"{folder}/t"
    dated(spark, date(2024, 1, 1), date(2024, 1, 2)).repartition(1).write.partitionBy("ingestion_date").parquet(path)
    spark.range(0).write.parquet(f"{path}/ingestion_date=2024-01-03")
    got = {r.ingestion_date: (r.objects, r.bytes > 0) for r in layout.file_inventory(spark, path, ["ingestion_date"]).collect()}
    assert got == {f"2024-01-0{n}": (1, True) for n in (1, 2, 3)}


def test_only_the_batch_s_part_of_the_target_is_read(spark, folder):
    path = f"{folder}/t"
    spark.range(100).withColumn("day", F.col("id") % 10).write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(3, 3), (203, 3), (4, 4)], "id long, day int")
    added = ingest.anti_existing(batch, spark.read.parquet(path), ["id", "day"], within="day")
    assert rows(added) == [(203, 3)]
    plan = added._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan.split("PartitionFilters:")[1].split("]")[0] and ">= 3" in plan


def test_pages_are_read_and_judged_once(spark):
    """What goes on is the judgement as staged: neither side parses a page or an asset again."""
    good = {"id": "a1", "symbol": "s", "name": "n", "image": "i", "last_updated": "2024-01-02T03:04:05Z", "current_price": 1.5}
    bodies = [
        json.dumps([good, None, {**good, "total_volume": "1e-30"}, {**good, "last_updated": "2024-01-02T03:04:05"}, 7]),
        "[]", "[ ", None, "{}", json.dumps([{**good, "max_supply": "1E+3"}]),
    ]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    assets, rejects = ingest.api_assets(pages)
    for side in (assets, rejects):
        assert "from_json" not in side._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.page, r.a.current_price, r.a.max_supply) for r in assets.collect())
    assert got == [(0, Decimal("1.5"), None), (5, Decimal("1.5"), Decimal(1000))]
    gone = {(r.page, r.reason, r.body if r.page else None) for r in rejects.collect()}
    assert rejects.count() == 7 and gone == {
        (0, "id is missing", None), (0, "total_volume is no decimal(38,18)", None), (0, "last_updated is no time with offset", None),
        (2, "page is not a JSON array", "[ "), (3, "page is not a JSON array", None), (4, "page is not a JSON array", "{}"),
    }
