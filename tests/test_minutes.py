"""What runs each minute: carried alerts, noted newest events, reports by day, recorded checks."""

import json
import random
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import series
from tidemark.plans import alerts, freshness, gold
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import CAPS, PRICES, bronze_schema
from tidemark.session import list_folders
from tidemark.streaming import alerting, incremental, newest, progress, sinks
from test_streaming import broker_report
from test_tables import prices

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def evaluated(spark, items):
    """(rule, minute, value, hold) as evaluations over a threshold of 1."""
    data = [(START + timedelta(minutes=m), rule, v, 1.0, hold) for rule, m, v, hold in items]
    return spark.createDataFrame(data, "ts timestamp, rule_uid string, value double, threshold double, hold_minutes int")


def a_day(rng):
    """A day of minutes of three rules: runs across midnight and chunk ends, gaps, no data."""
    items = []
    for rule, hold in (("now", 0), ("five", 5), ("long", 30)):
        over = False
        for minute in range(24 * 60 + 90):
            over = over != (rng.random() < 0.04)
            if rng.random() > 0.02:
                items.append((rule, minute, None if rng.random() < 0.01 else 2.0 if over else 0.0, hold))
    return items


def test_steps_of_any_size_equal_the_whole(spark, folder):
    rng = random.Random(3)
    items = a_day(rng)
    whole = rows(series.alert_hold(evaluated(spark, items)))
    at, number = 0, 0
    while at <= 24 * 60 + 90:
        size = rng.choice([1, 7, 300, 500])
        part = [i for i in items if at <= i[1] < at + size]
        alerting.advance(evaluated(spark, part), f"{folder}/alerts", number)
        at, number = at + size, number + 1
    columns = evaluated(spark, []).columns
    got = alerting.states(spark, f"{folder}/alerts").select(*columns, "since", "state")
    assert rows(got) == whole
    assert alerting.merge_days(spark, f"{folder}/alerts") > 1
    assert rows(alerting.states(spark, f"{folder}/alerts").select(*columns, "since", "state")) == whole
    assert len(list_folders(spark, f"{folder}/alerts.held/*")) == min(number, alerting.KEPT_STEPS)


def test_minute_by_minute(spark, folder):
    """One minute at a time, some steps run twice, and nothing older than the last step is read."""
    items = [i for i in a_day(random.Random(8)) if i[1] < 12]
    whole = rows(series.alert_hold(evaluated(spark, items)))
    for minute in range(12):
        part = evaluated(spark, [i for i in items if i[1] == minute])
        for _ in range(2 if minute % 8 == 0 else 1):
            alerting.advance(part, f"{folder}/alerts", minute)
        if minute == 10:
            held = alerting.held(spark, f"{folder}/alerts")
            read = series.continue_hold(part, held).inputFiles()
            assert not [f for f in read if "/alerts/" in f]
    got = alerting.states(spark, f"{folder}/alerts")
    assert rows(got.select(*evaluated(spark, []).columns, "since", "state")) == whole


def test_settled_evaluations_stay(spark, folder):
    """What comes again or too late changes nothing."""
    first = [("r", m, 2.0, 0) for m in range(5)]
    alerting.advance(evaluated(spark, first), f"{folder}/a", 1)
    alerting.advance(evaluated(spark, first[2:] + [("r", 5, 2.0, 0)]), f"{folder}/a", 2)
    alerting.advance(evaluated(spark, []), f"{folder}/a", 3)
    got = rows(alerting.states(spark, f"{folder}/a").select(F.minute("ts"), F.minute("since"), "state"))
    assert got == sorted((m, 0, "firing") for m in range(6))


def test_a_stream_of_evaluations(spark, folder):
    items = [("r", m, 2.0 if 3 < m < 20 else 0.0, 5) for m in range(30)]
    for part in range(3):
        evaluated(spark, items[part * 10 : part * 10 + 10]).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = spark.readStream.schema(evaluated(spark, []).schema).json(f"{folder}/in")
        alerting.alert_stream(stream, f"{folder}/alerts", f"{folder}/check", available_now=True).awaitTermination()
    got = alerting.states(spark, f"{folder}/alerts").select(*evaluated(spark, []).columns, "since", "state")
    assert rows(got) == rows(series.alert_hold(evaluated(spark, items)))


# --- freshness --------------------------------------------------------------


def test_health_without_reading_a_fact(spark, folder):
    for n in range(3):
        prices(spark, n * 10, n * 10 + 10).coalesce(1).write.mode("append").parquet(f"{folder}/bronze")
    stream = spark.readStream.schema(bronze_schema(PRICES)).option("maxFilesPerTrigger", 1).parquet(f"{folder}/bronze")
    path = f"{folder}/fct"
    incremental.fact_stream(stream, PRICES, path, f"{folder}/check", available_now=True).awaitTermination()
    now = datetime(1970, 1, 2)
    facts = gold.fact_rows(spark.read.schema(bronze_schema(PRICES)).parquet(f"{folder}/bronze"), PRICES)
    want = rows(freshness.pipeline_health({"t": facts}, now))
    for folded in (3, 4, 2):  # the notes, those and the folded one, that and the next
        health = freshness.pipeline_health({"t": newest.read(spark, path)}, now)
        assert rows(health) == want and all(".newest/" in f for f in health.inputFiles())
        assert newest.fold(spark, path) <= folded
    assert rows(freshness.pipeline_health({"t": newest.read(spark, path)}, now)) == want


def test_a_batch_without_facts_notes_nothing(spark, folder):
    newest.note(spark, f"{folder}/t", "0", [])
    health = freshness.pipeline_health({"t": newest.read(spark, f"{folder}/t")}, datetime(2024, 1, 1)).first()
    assert (health.latest_event_time, health.pipeline_status) == (None, "empty")


# --- reports ----------------------------------------------------------------


def keep(log, name, minutes, start=START, rejected=(), behind=0):
    for m in minutes:
        at = start + timedelta(minutes=m)
        report = json.loads(broker_report(name, 0, behind, rejected=int(m in rejected)))
        log.keep(name, m, json.dumps({**report, "batchId": m, "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.000Z")}))


def test_reports_are_rolled_by_day_and_dropped(spark, folder):
    path = f"{folder}/progress"
    assert progress.reports(spark, path).count() == 0
    log = progress.ProgressLog(spark, path)
    for day in (0, 10, 15, 16, 17):
        keep(log, "bronze-market_prices", range(5), START + timedelta(days=day))
    today = date(2024, 1, 18)
    whole = rows(progress.progress_rows(progress.reports(spark, path)))
    assert progress.roll_reports(spark, path, today) == ["2024-01-11", "2024-01-16"]
    kept = rows(progress.progress_rows(progress.reports(spark, path)))
    assert kept == whole[5:] and len(kept) == 20
    assert progress.roll_reports(spark, path, today) == []
    assert rows(progress.progress_rows(progress.reports(spark, path))) == kept
    assert [f.rsplit("/", 1)[1] for f in list_folders(spark, f"{path}/day=*")] == ["day=2024-01-17", "day=2024-01-18"]
    recent = progress.reports(spark, path, date(2024, 1, 18))
    assert recent.count() == 5 and all("day=2024-01-18" in f for f in recent.inputFiles())


def test_a_fresh_root_has_no_alerts(spark, folder):
    lake = Warehouse(spark, f"{folder}/lake")
    assert lake.alerts().count() == 0 == lake.alerts_again().count()
    assert lake.consumer_lag().count() == 0


def test_recorded_minutes_settle_what_the_whole_history_says(spark, folder):
    """Checks of some minutes: landing misses a batch for a while, batches are rejected, a consumer falls behind."""
    root = f"{folder}/lake"
    lake = Warehouse(spark, root, incremental=True)
    for feed in (PRICES, CAPS):
        path = f"{root}/models/fct_{feed.name}"
        spark.createDataFrame([(int(START.timestamp() * 1000),)], "event_time_ms bigint").write.parquet(f"{folder}/{feed.name}")
        newest.note(spark, path, "0", [f"{folder}/{feed.name}"])
    empty = {f: spark.createDataFrame([], bronze_schema(f)) for f in (PRICES, CAPS)}
    for feed in (PRICES, CAPS):
        sinks.bronze_sink(empty[feed], lake.bronze_path(feed), feed, 0)
        sinks.lz_sink(empty[feed], f"{root}/lz", feed, 0)
    log = progress.ProgressLog(spark, f"{lake.monitoring}/progress")
    keep(log, "bronze-market_prices", range(0, 40), rejected=(3,), behind=2000)
    late = prices(spark, 0, 10, date(2024, 1, 1), "07")
    minutes = [0, 5, 6, 7, 33, 34, 36, 37, 38]
    for minute in minutes:
        if minute == 6:
            sinks.bronze_sink(late, lake.bronze_path(PRICES), PRICES, 1)
        if minute == 37:
            sinks.lz_sink(late, f"{root}/lz", PRICES, 1)
        lake.record_checks(START + timedelta(minutes=minute, seconds=20))
    settled = {(r.rule_uid, int((r.ts - START.replace(tzinfo=None)).total_seconds() // 60)): r.state for r in lake.alerts().collect()}
    again = {(r.rule_uid, int((r.ts - START.replace(tzinfo=None)).total_seconds() // 60)): r.state for r in lake.alerts_again().collect()}
    assert settled == {k: v for k, v in again.items() if k[1] < 38 or k[0] in (alerts.STALE.uid, alerts.MISMATCH.uid)}
    assert [settled[alerts.MISMATCH.uid, m] for m in (5, 6, 36, 37)] == ["normal", "pending", "pending", "normal"]
    assert settled[alerts.STALE.uid, 33] == settled[alerts.STALE.uid, 38] == "pending"
    assert settled[alerts.DEAD_LETTERS.uid, 4] == "firing" and settled[alerts.CONSUMER_LAG.uid, 37] == "firing"
    lake.record_checks(START + timedelta(minutes=38, seconds=50))  # the same minute once more
    assert lake.alerts().count() == len(settled)
    report = lake.sink_validation()
    assert all(".log/" in f for f in [*report.inputFiles(), *lake.sink_validation_partition().inputFiles()])
    assert all(".newest/" in f for f in lake.pipeline_health().inputFiles())
