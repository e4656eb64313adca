"""Levels of parts, exact counts under replacement, and what of a target a batch reads."""

import random
from datetime import date, datetime, timedelta
from math import log

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import ingest
from tidemark.plans import gold, silver
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import PRICES, bronze_schema
from tidemark.session import list_folders
from tidemark.streaming import incremental, newest, sinks
from tidemark.streaming.incremental import merges, tier
from test_tables import prices


def simulated(batches, fanout, size=100_000):
    """Bytes rewritten and the most parts a reader meets, if every batch adds keys of its own."""
    parts, rewritten, most = {}, 0, 0
    for n in range(batches):
        parts[f"b{n:05d}"] = size
        chosen = merges(parts, fanout)
        if chosen:
            total = sum(parts.pop(c) for c in chosen)
            parts[f"m{n:05d}"] = total
            rewritten += total
        most = max(most, len(parts))
    assert sum(parts.values()) == batches * size
    return rewritten / batches / size, most


@pytest.mark.parametrize("fanout", [2, 4, 8])
def test_bytes_rewritten_per_batch_grow_with_the_logarithm(fanout):
    found = {n: simulated(n, fanout) for n in (200, 2000, 20000)}
    for n, (per_batch, most) in found.items():
        # small parts of the first tier are merged again until they leave it
        first = incremental.SMALL_PART / 100_000
        assert per_batch <= first + 2 * (log(n, fanout) + 2)
        assert most <= first * fanout + fanout * (log(n, fanout) + 2)
    assert found[20000][0] - found[2000][0] < 2 * (found[2000][0] - found[200][0]) + 4


def test_tiers_and_limits():
    small = incremental.SMALL_PART
    assert [tier(s, 4) for s in (0, small, small + 1, 4 * small, 4 * small + 1)] == [0, 0, 1, 1, 2]
    assert merges({"a": 1}, 2) == [] and merges({}, 2) == []
    assert merges({"a": 1, "b": 9 * small, "c": 2}, 2) == ["a", "c"]
    assert merges({"a": 9 * small, "b": 9 * small, "c": 2}, 2) == ["c", "a", "b"]
    assert merges({"a": 9 * small, "b": 9 * small, "c": 2}, 2, most_bytes=small) == []


def test_state_is_the_same_at_every_level(spark, folder):
    """Batches with older and newer versions of five assets, merged four parts at a time."""
    payload = silver.state_payload(PRICES)
    for n in range(9):
        prices(spark, n * 7, n * 7 + 9).coalesce(1).write.mode("append").parquet(f"{folder}/bronze")
        whole = spark.read.schema(bronze_schema(PRICES)).parquet(f"{folder}/bronze")
        stream = spark.readStream.schema(bronze_schema(PRICES)).parquet(f"{folder}/bronze")
        incremental.latest_state_stream(stream, payload, f"{folder}/state", f"{folder}/check", available_now=True).awaitTermination()
        incremental.compact_silver(spark, f"{folder}/state", PRICES, fanout=4)
    shape = incremental.state_shape(spark, PRICES)
    assert rows(incremental.read_state(spark, f"{folder}/state", shape)) == rows(silver.latest_state(whole, PRICES))
    assert len(list_folders(spark, f"{folder}/state/batch_id=merged-*")) >= 1


def test_models_that_begin_after_a_compaction(spark, folder):
    """Bronze is compacted and cleaned before any model stream has run; more rows come, and more of that."""
    lake, live = (Warehouse(spark, f"{folder}/lake", datetime(2024, 1, 9), incremental=i) for i in (False, True))
    path = lake.bronze_path(PRICES)
    for round_ in range(2):
        for n in range(round_ * 3, round_ * 3 + 3):
            sinks.bronze_sink(prices(spark, n * 10, n * 10 + 12, date(2024, 1, 2 + n)), path, PRICES, n)
        for _ in range(3):
            lake.tidy(most_files=1)
        if round_ == 0:
            assert list_folders(spark, f"{path}/*/*.parquet") == []
        for query in live.start_models(available_now=True):
            query.awaitTermination()
        assert rows(live.silver(PRICES)) == rows(lake.silver(PRICES)) and live.silver(PRICES).count() == 5
        assert rows(live.dim_asset().drop("updated_at")) == rows(lake.dim_asset().drop("updated_at"))
        facts = lake.facts(PRICES).drop("loaded_at")
        assert rows(live.facts(PRICES).drop("loaded_at")) == rows(facts)
        counts = {r.table_name: r["rows"] for r in live.row_counts().collect()}
        assert counts == {"bronze.market_prices": 36 * (round_ + 1) + 2 * round_, "gold.fct_market_prices": facts.count(), "bronze.market_caps": 0, "gold.fct_market_caps": 0}
        # the streams read what came before it was compacted, so the next files stay until then
        sinks.bronze_sink(prices(spark, 900, 902, date(2024, 1, 8)), path, PRICES, "again")


# --- counts -----------------------------------------------------------------


def test_added_keys_are_the_deduplicated_count(spark, folder, monkeypatch):
    """Facts that come again, late ones, deletes, merged parts, folded notes and a batch that runs twice."""
    rng, path = random.Random(4), f"{folder}/fct"

    def batch(n, fail=False):
        days = [rng.randrange(120) for _ in range(12)] + [rng.randrange(5) for _ in range(6)]
        data = [(f"a{rng.randrange(3)}", int((datetime(2024, 1, 1) + timedelta(days=d)).timestamp() * 1000), rng.choice("uud")) for d in days]
        found = spark.createDataFrame(data, "assetId string, eventTimeMs bigint, op string").withColumn("lsn", F.lit(n).cast("bigint"))
        made = prices(spark, 0, 1).limit(0).unionByName(found, allowMissingColumns=True)
        made.coalesce(1).write.mode("append").parquet(f"{folder}/bronze")

    def run():
        stream = spark.readStream.schema(bronze_schema(PRICES)).parquet(f"{folder}/bronze")
        incremental.fact_stream(stream, PRICES, path, f"{folder}/check", available_now=True).awaitTermination()

    for n in range(6):
        batch(n)
        if n == 3:  # the batch is written and dies before its note
            with monkeypatch.context() as patched:
                patched.setattr(newest, "note", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(Exception, match="lost"):
                    run()
        run()
        whole = gold.fact_rows(spark.read.schema(bronze_schema(PRICES)).parquet(f"{folder}/bronze"), PRICES)
        assert newest.added(spark, path) == whole.select(*gold.FACT_KEY).distinct().count()
        if n in (2, 4):
            incremental.compact_facts(spark, path, PRICES)
            newest.fold(spark, path)
            assert newest.added(spark, path) == incremental.read_facts(spark, path, PRICES).count()


def test_a_note_without_a_count_gives_none(spark, folder):
    newest.note(spark, f"{folder}/t", "0", [])
    assert newest.added(spark, f"{folder}/t") is None


# --- what of a target is read -----------------------------------------------


def test_ranges_leave_out_the_widest_gaps(spark):
    frame = spark.createDataFrame([(v,) for v in [*range(100, 120), *range(5000, 5010), 10**12, None]], "v bigint")
    assert ingest.value_ranges(frame, "v") == [(100, 5009), (10**12, 10**12)]
    assert ingest.value_ranges(frame.where("v < 10000"), "v") == [(100, 119), (5000, 5009)]
    assert ingest.value_ranges(frame.where("v is null"), "v") == []
    one_by_one = spark.range(0, 200_000, 1000).select(F.col("id").alias("v"))
    few = ingest.value_ranges(one_by_one, "v", most=10)
    assert len(few) <= 10 and few[0][0] == 0 and few[-1][1] == 199_000
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)] + [(date(2020, 1, 1),)], "v date")
    assert ingest.value_ranges(days, "v") == [(date(2020, 1, 1), date(2020, 1, 1)), (date(2024, 1, 1), date(2024, 1, 3))]
    texts = spark.createDataFrame([("b",), ("a",), ("z",)], "v string")
    assert ingest.value_ranges(texts, "v") == [("a", "z")]
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert len(ingest.value_ranges(odd, "v")) == 1
    assert ingest.within_ranges(frame, "v", [(5000, 5003), (10**12, 10**12)]).count() == 5


def test_one_late_row_reads_its_own_day_only(spark, folder):
    path = f"{folder}/t"
    target = spark.range(400).select("id", F.date_add(F.lit(date(2023, 1, 1)), F.col("id").cast("int")).alias("day"))
    target.repartition("day").write.partitionBy("day").parquet(path)
    held = spark.read.parquet(path)
    late = [(0, date(2023, 1, 1)), (398, date(2024, 2, 3)), (399, date(2024, 2, 4)), (1000, date(2024, 2, 4)), (1000, date(2024, 2, 4)), (7, None)]
    batch = spark.createDataFrame(late, "id bigint, day date").withColumn("at", F.monotonically_increasing_id())
    near = ingest.within_ranges(held, "day", ingest.value_ranges(batch, "day"))
    assert near.count() == 3
    added = ingest.insert_ignore(batch, held, ["id", "day"], ["at"], within="day")
    assert rows(added.select("id", "day")) == rows(spark.createDataFrame([(1000, date(2024, 2, 4)), (7, None)], "id bigint, day date"))
    assert rows(added.drop("at")) == rows(ingest.insert_ignore(batch, held, ["id", "day"], ["at"]).drop("at"))
