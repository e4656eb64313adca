"""A snapshot taken range by range beside live changes, stopped and taken up again."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans import silver
from tidemark.schemas import PRICES
from tidemark.session import list_folders
from tidemark.sources import changes, landing
from tidemark.streaming import pipeline
from test_cdc import IMAGE, SOURCE, envelope
from test_streaming import write_files

AT = "2024-01-02 00:00:00"


class Source:
    """A source table whose rows change while it is read: version 100 + n is the n-th change."""

    def __init__(self, spark, folder, assets=40):
        self.spark, self.folder, self.version = spark, folder, 100
        self.prices = {n: 1 for n in range(assets)}
        write_files(spark, f"{folder}/live", [], 1)

    def table(self):
        data = [(*{**IMAGE, "asset_id": f"a{n}", "price": str(p)}.values(), None if n == 7 else n) for n, p in sorted(self.prices.items())]
        return self.spark.createDataFrame(data, ", ".join(f"{k} string" for k in IMAGE) + ", number int")

    def change(self, *numbers):
        events = []
        for n in numbers:
            self.version += 1
            self.prices[n] = self.version
            events.append(envelope(asset_id=f"a{n}", price=str(self.version), op="u", source={**SOURCE, "lsn": self.version}))
        write_files(self.spark, f"{self.folder}/live", events, 1)

    def run(self, chunks=4, out="out"):
        stream = changes.cdc_stream(self.spark, PRICES, f"{self.folder}/live")
        targets = pipeline.Targets(landing=f"{self.folder}/{out}/lz", bronze=f"{self.folder}/{out}/bronze")
        events = lambda part, low: changes.snapshot_envelopes(part, PRICES, F.lit(low))
        pipeline.snapshot_in_chunks(
            self.spark, self.table, events, stream, PRICES, targets, f"{self.folder}/{out}/check", "number", lambda: self.version, chunks, available_now=True, at=F.lit(AT).cast("timestamp")
        ).awaitTermination()

    def bronze(self, out="out"):
        return landing.bronze_scan(self.spark, f"{self.folder}/{out}/bronze", PRICES)

    def state(self, out="out"):
        return {int(r.asset_id[1:]): int(r.price) for r in silver.silver_prices(self.bronze(out)).collect()}


def test_whole_in_one_run(spark, folder):
    source = Source(spark, folder)
    source.change(3, 30)
    source.run()
    assert source.state() == source.prices
    assert rows(source.bronze().groupBy("op").count()) == [("r", 40), ("u", 2)]
    assert rows(landing.lz_scan(spark, f"{folder}/out/lz", PRICES)) == rows(source.bronze())
    source.change(3, 4)
    source.run()  # a restart takes up the live changes only
    assert source.state() == source.prices and source.bronze().count() == 44
    assert list_folders(spark, f"{folder}/out/check/chunks/*.rows") == []
    marks = [json.loads(spark.read.text(f).first()[0]) for f in list_folders(spark, f"{folder}/out/check/chunks/*.done")]
    assert len(marks) == 5 and all(m["low"] <= m["high"] for m in marks)  # four ranges and the rows without a number


@pytest.mark.parametrize("died", ["read", "landing", "bronze"])
def test_stopped_at_half_and_taken_up(spark, folder, monkeypatch, died):
    """Rows change between the ranges, and again before the second try; the result is that of a run that never stopped."""
    source = Source(spark, folder)
    source.change(1, 12, 39)
    real, calls = pipeline.fan_out, []

    def changing(checked, batch, *rest):
        if str(batch).startswith("snapshot"):
            calls.append(batch)
            if len(calls) == 3:
                if died == "read":
                    raise RuntimeError("lost")
                with monkeypatch.context() as inner:
                    inner.setattr(pipeline, "lz_sink" if died == "landing" else "bronze_sink", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                    real(checked, batch, *rest)
            source.change(len(calls), 20 + len(calls))
        return real(checked, batch, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "fan_out", changing)
        with pytest.raises(RuntimeError, match="lost"):
            source.run()
    # live changes did not wait for the snapshot's end
    assert {r.op for r in source.bronze().collect()} == {"r", "u"}
    half = source.bronze().where("op = 'r'").count()
    assert 0 < half < 40
    source.change(15, 25, 35)
    source.run()
    assert source.state() == source.prices
    assert source.bronze().where("op = 'r'").select("assetId").distinct().count() == 40 == source.bronze().where("op = 'r'").count()
    assert rows(landing.lz_scan(spark, f"{folder}/out/lz", PRICES)) == rows(source.bronze())
    source.run(chunks=1, out="other")
    assert source.state("other") == source.state()


def test_an_empty_source(spark, folder):
    source = Source(spark, folder, assets=0)
    source.change(3)
    source.run()
    assert source.state() == {3: 101}
