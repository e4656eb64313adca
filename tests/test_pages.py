"""Page files to source tables: keys once, rejects with their reason, batches that run again."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import CAPS, PRICES
from tidemark.session import list_folders
from tidemark.sources import changes
from tidemark.streaming import app, pages


def asset(n, day, **fields):
    base = {"id": f"a{n}", "symbol": f"s{n}", "name": f"Coin {n}", "image": "https://img.example/x.png", "last_updated": f"2024-01-{day:02}T03:04:05Z",
            "current_price": 1.5, "market_cap": 10, "total_volume": 2, "circulating_supply": 3, "total_supply": 4, "max_supply": None}
    return {**base, **fields}


PAGES = [
    json.dumps([asset(1, 1), asset(2, 1), asset(3, 1, current_price="n/a")]),
    json.dumps([asset(1, 1, current_price=9), asset(4, 1, market_cap=10**17)]),
    '{"error": "rate limit"}',
    json.dumps([asset(1, 2), asset(2, 1, name=None), asset(5, 1)]),
]


def as_table(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page int, body string")


def keys(table):
    return sorted((r.asset_id, r.event_time.day) for r in table.collect())


def test_batches_add_what_the_tables_lack(spark, folder):
    for number, part in enumerate((PAGES[:3], PAGES[3:], PAGES[3:] + PAGES[:1])):
        for _ in range(2 if number == 1 else 1):
            pages.take_pages(as_table(spark, part), folder, datetime(2024, 1, 3, number), number)
    prices, caps = (pages.source_table(spark, folder, f.name) for f in (PRICES, CAPS))
    assert keys(prices) == [("a1", 1), ("a1", 2), ("a2", 1), ("a5", 1)]
    assert keys(caps) == keys(prices)  # the cap of 10^17 and the price that is none are refused
    first = prices.where("asset_id = 'a1' and day(event_time) = 1").first()
    assert first.source_ts == datetime(2024, 1, 3) and str(first.price.normalize()) in ("1.5", "9")
    found = pages.rejects(spark, folder)
    got = {(r.batch_id, r.table_name, r.reason) for r in found.collect()}
    assert ("0", None, "page is not a JSON array") in got and ("0", None, "current_price is no decimal(38,18)") in got
    assert {("0", t.name, "market_cap exceeds numeric(18,2)") for t in (PRICES, CAPS)} <= got
    assert {("1", None, "name is missing"), ("2", None, "name is missing")} <= got
    assert found.where("batch_id = '1'").count() == 1


def test_the_job_end_to_end(spark, folder):
    """Files through the command line, twice, and the table as a snapshot of the feed."""
    for n, bodies in enumerate((PAGES[:2], PAGES[2:])):
        for k, body in enumerate(bodies):
            spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{folder}/in/{n}-{k}")
        app.main(["--pages", "--root", f"{folder}/lake", "--location", f"{folder}/in/*", "--available-now", "--max-per-batch", "10"])
    lake = Warehouse(spark, f"{folder}/lake")
    assert keys(lake.source_table(PRICES)) == keys(lake.source_table(CAPS)) == [("a1", 1), ("a1", 2), ("a2", 1), ("a5", 1)]
    assert len(list_folders(spark, f"{folder}/lake/source/market_prices/event_day=*")) == 2
    events = changes.snapshot_envelopes(lake.source_table(PRICES), PRICES, F.lit(1))
    assert rows(events.select("envelope.after.asset_id", "envelope.after.price"))[0] == ("a1", "1.500000000000000000")
    assert pages.rejects(spark, f"{folder}/lake/source").count() == 5


def test_nothing_yet(spark, folder):
    assert pages.source_table(spark, folder, "market_prices").count() == 0 == pages.rejects(spark, folder).count()
    pages.take_pages(as_table(spark, []), folder, datetime(2024, 1, 1), 0)
    assert pages.source_table(spark, folder, "market_prices").count() == 0
