"""Counters and alert holds, against row-by-row walks."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import series
from tidemark.plans import activity, alerts

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes):
    return START + timedelta(minutes=minutes)


def hold(spark, points, minutes, **options):
    """States of one rule over (minute, value) points with threshold 0."""
    data = [(at(m), "r", v, 0.0, minutes) for m, v in points]
    df = spark.createDataFrame(data, "ts timestamp, rule_uid string, value double, threshold double, hold_minutes int")
    return [r.state for r in series.alert_hold(df, **options).orderBy("ts").collect()]


def test_hold_time(spark):
    assert hold(spark, [(m, 1.0) for m in range(5)], 5) == ["pending"] * 5
    assert hold(spark, [(m, 1.0) for m in range(6)], 5) == ["pending"] * 5 + ["firing"]
    assert hold(spark, [(0, 1.0)], 0) == ["firing"]
    assert hold(spark, [(0, 0.0), (1, None)], 0) == ["normal", "normal"]


def test_a_gap_starts_again(spark):
    no_data = [(0, 1.0), (1, 1.0), (2, None), (3, 1.0), (4, 1.0), (5, 1.0)]
    assert hold(spark, no_data, 2) == ["pending", "pending", "normal", "pending", "pending", "firing"]
    missing = [(0, 1.0), (1, 1.0), (3, 1.0), (4, 1.0), (5, 1.0)]
    assert hold(spark, missing, 2) == ["pending", "pending", "pending", "pending", "firing"]


def walk(points, hold_minutes):
    states, since, last = [], None, None
    for minute, value in points:
        if value is None or value <= 0:
            since = None
            states.append("normal")
        else:
            if since is None or minute - last > 1:
                since = minute
            states.append("firing" if minute - since >= hold_minutes else "pending")
        last = minute
    return states


@pytest.mark.parametrize("seed", range(4))
def test_holds_across_chunks(spark, seed):
    """Chunks far shorter than the runs, so nearly every run crosses some."""
    draw = random.Random(seed)
    points = [(m, draw.choice([1.0] * 12 + [0.0, None])) for m in range(400) if draw.random() > 0.04]
    for chunk in (60, 7 * 60, 86400):
        assert hold(spark, points, 6, chunk_seconds=chunk) == walk(points, 6)


@pytest.mark.parametrize("seed", range(3))
def test_deltas_across_chunks(spark, seed):
    draw = random.Random(seed)
    data, want = [], []
    for topic in ("x", "y"):
        value, before = 0, None
        for minute in sorted(draw.sample(range(3000), 120)):
            value = draw.randrange(5) if draw.random() < 0.1 else value + draw.randrange(4)
            data.append((topic, 0, at(minute), value))
            want.append((topic, minute, 0 if before is None else value if value < before else value - before))
            before = value
    df = spark.createDataFrame(data, "topic string, partition int, ts timestamp, current_offset bigint")
    for chunk in (60, 3600, 86400):
        got = series.counter_delta(df, chunk_seconds=chunk).collect()
        minutes = lambda r: int((r.ts.replace(tzinfo=timezone.utc) - START).total_seconds() // 60)
        assert sorted((r.topic, minutes(r), r.delta) for r in got) == sorted(want)


def offsets(spark, *points, topic="bronze.prices.dlq"):
    data = [(topic, 0, at(m), v) for m, v in points]
    return spark.createDataFrame(data, "topic string, partition int, ts timestamp, current_offset bigint")


def test_increase_covers_the_window_and_resets(spark):
    df = offsets(spark, (0, 10), (1, 12), (5, 3), (30, 4))
    got = {r.ts: r.increase for r in series.counter_increase(df, alerts.DLQ_PATTERN, 10).collect()}
    naive = lambda m: at(m).replace(tzinfo=None)
    assert got[naive(0)] == 0 and got[naive(1)] == 2 and got[naive(5)] == 5
    assert got[naive(10)] == 5 and got[naive(11)] == 3 and naive(15) not in got
    assert got[naive(30)] == 1 and max(got) == naive(30)


def test_patterns_match_whole_labels(spark):
    df = offsets(spark, (0, 1), (1, 2), topic="old.bronze.prices.dlq")
    assert series.counter_increase(df, alerts.DLQ_PATTERN).count() == 0
    assert series.counter_rate(df, r"old\..*").count() == 2


def test_rate_is_per_second(spark):
    got = series.counter_rate(offsets(spark, (0, 0), (1, 60), (2, 60)), ".*")
    assert [r.per_second for r in got.orderBy("ts").collect()] == [0.0, 1.0, 0.0]


def test_consumer_lag_of_matching_groups(spark):
    data = [("flink-bronze-a", "t", 0, 10, 4), ("flink-bronze-b", "t", 0, 5, 5), ("x-flink-bronze-c", "t", 0, 99, 0)]
    df = spark.createDataFrame(data, "consumergroup string, topic string, partition int, end_offset bigint, committed_offset bigint")
    assert activity.consumer_lag(df.withColumn("ts", F.lit(START))).first().lag == 6


def test_checkpoint_durations(spark):
    data = [("a", at(0), 5), ("a", at(1), 3), ("b", at(0), 4)]
    df = spark.createDataFrame(data, "job_name string, ts timestamp, duration_ms bigint")
    assert rows(activity.checkpoint_duration(df)) == [("a", 3, 5), ("b", 4, 4)]
    assert activity.checkpoint_duration_max(df).first().max_last_ms == 4


def test_the_four_rules(spark):
    minutes = range(12)
    health = spark.createDataFrame([(at(m), "t", 31) for m in minutes], "checked_at timestamp, table_name string, minutes_lag bigint")
    checks = spark.createDataFrame(
        [(at(m), "t", "MISMATCH") for m in minutes], "checked_at timestamp, table_name string, validation_status string"
    )
    lag = spark.createDataFrame(
        [(at(m), "flink-bronze-a", "t", 0, 2000, 999) for m in minutes],
        "ts timestamp, consumergroup string, topic string, partition int, end_offset bigint, committed_offset bigint",
    )
    dlq = offsets(spark, (0, 0), (1, 1))
    states = alerts.alerts(health_history=health, validation_history=checks, topic_offsets=dlq, consumer_offsets=lag)
    firing = {r.rule_uid: r.n for r in states.groupBy("rule_uid").agg(F.count_if(F.col("state") == "firing").alias("n")).collect()}
    assert firing == {"pipeline-lag-stale": 7, "sink-validation-mismatch": 2, "dlq-records": 1, "consumer-lag": 2}


def test_running_totals_over_chunks(spark):
    """A series that ends in the first chunk, one that spans many, and a null."""
    data = [("a", at(m), None if m % 7 == 0 else m) for m in range(0, 5000, 13)] + [("b", at(m), 1) for m in range(3)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v int").repartition(3)
    got = series.running_total(series.chunked(df, "ts", 3600), ["k"], "ts", {"total": F.col("v")})
    sums, want = {}, []
    for k, ts, v in sorted(data, key=lambda r: (r[0], r[1])):
        sums[k] = sums.get(k, 0) + (v or 0)
        want.append((k, sums[k]))
    assert [tuple(r) for r in got.orderBy("k", "ts").select("k", "total").collect()] == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan


def test_increase_reads_its_samples_once(spark, folder):
    samples = spark.createDataFrame([("t", 0, at(m), m) for m in range(30)], "topic string, partition int, ts timestamp, current_offset int")
    samples.write.parquet(f"{folder}/samples")
    plan = series.counter_increase(spark.read.parquet(f"{folder}/samples"), "t")._jdf.queryExecution().executedPlan().toString()
    assert f"{folder}/samples" not in plan
