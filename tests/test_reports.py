"""Freshness and reconciliation."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.clock import as_instant, minutes_between
from tidemark.plans import activity, freshness, reconcile
from tidemark.schemas import PRICES, bronze_schema

NOW = datetime(2024, 1, 31)


def facts(spark, *times):
    from datetime import timezone

    millis = [(int(t.replace(tzinfo=timezone.utc).timestamp() * 1000),) for t in times]
    return spark.createDataFrame(millis, "event_time_ms bigint")


@pytest.mark.parametrize(
    ("minutes", "status"), [(0, "healthy"), (10, "healthy"), (11, "delayed"), (30, "delayed"), (31, "stale")]
)
def test_lag_limits(spark, minutes, status):
    health = freshness.pipeline_health({"t": facts(spark, NOW - timedelta(minutes=minutes))}, NOW).first()
    assert (health.minutes_lag, health.pipeline_status) == (minutes, status)


def test_an_empty_table_and_an_unset_time(spark):
    tables = {"none": facts(spark), "epoch": facts(spark, datetime(1970, 1, 1))}
    got = rows(freshness.pipeline_health(tables, NOW).select("table_name", "pipeline_status"))
    assert got == [("epoch", "empty"), ("none", "empty")]
    assert freshness.pipeline_health({"none": facts(spark)}, NOW).first().minutes_lag is None


def test_minutes_are_boundaries(spark):
    a, b = as_instant(datetime(2024, 1, 1, 10, 0, 59)), as_instant(datetime(2024, 1, 1, 10, 1, 0))
    assert spark.range(1).select(minutes_between(a, b)).first()[0] == 1


def test_worst_status(spark):
    for statuses, worst in [
        (["healthy", "stale", "empty"], "STALE"),
        (["delayed", "empty"], "EMPTY"),
        (["healthy", "delayed"], "DELAYED"),
        (["healthy"], "HEALTHY"),
    ]:
        df = spark.createDataFrame([(s,) for s in statuses], "pipeline_status string")
        assert freshness.pipeline_status(df).first().status == worst


def bronze(spark, *items):
    """(asset, lsn, price, cap, hour) rows ingested on 2024-01-30."""
    data = [(a, n, p and Decimal(p), c and Decimal(c), h) for a, n, p, c, h in items]
    df = spark.createDataFrame(
        data, "assetId string, lsn bigint, price decimal(38,18), marketCap decimal(38,18), ingestion_hour string"
    ).withColumn("ingestion_date", F.lit(date(2024, 1, 30)))
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in bronze_schema(PRICES)]
    )


BASE = [("a", 1, "1", "10", "01"), ("b", 2, "2", None, "01"), ("c", 3, "3", "30", "02")]


def verdict(spark, left, right):
    got = reconcile.sink_validation(bronze(spark, *left), bronze(spark, *right), PRICES, NOW).first()
    return got.validation_status, got.row_count_match, got.checksum_match


def test_equal_copies_in_any_order(spark):
    assert verdict(spark, BASE, BASE[::-1]) == ("HEALTHY", True, True)


@pytest.mark.parametrize(
    ("change", "count_matches"),
    [
        (BASE[:2], False),
        ([*BASE, BASE[0]], False),
        ([("a", 1, "1.000000000000000001", "10", "01"), *BASE[1:]], True),
        ([BASE[0], ("b", 2, None, "2", "01"), BASE[2]], True),
        ([], False),
    ],
)
def test_drift_is_found(spark, change, count_matches):
    assert verdict(spark, BASE, change) == ("MISMATCH", count_matches, False)


def test_two_empty_copies_agree(spark):
    assert verdict(spark, [], []) == ("HEALTHY", True, True)


def test_only_trailing_days_are_compared(spark):
    old = bronze(spark, *BASE[:1]).withColumn("ingestion_date", F.lit(date(2024, 1, 23)))
    right = bronze(spark, *BASE[1:])
    assert reconcile.sink_validation(old.unionByName(right), right, PRICES, NOW).first().validation_status == "HEALTHY"


def test_partitions(spark):
    left = bronze(spark, *BASE, ("d", 9, "1", "1", "03"))
    right = bronze(spark, *BASE[:2], ("c", 3, "4", "30", "02"), ("e", 8, "1", "1", "04"))
    got = reconcile.sink_validation_partition(left, right, PRICES, NOW)
    assert rows(got.select("ingestion_hour", "validation_status")) == [
        ("01", "HEALTHY"), ("02", "MISMATCH"), ("03", "MISSING_PARTITION"), ("04", "MISSING_PARTITION"),
    ]


def test_failures_and_panel(spark):
    report = reconcile.sink_validation(bronze(spark, *BASE), bronze(spark), PRICES, NOW)
    assert reconcile.validation_failures(report).first().failures == 1
    assert len(reconcile.validation_panel(report).columns) == 6


def test_insert_rate_of_the_last_hour(spark):
    df = facts(spark, NOW - timedelta(minutes=61), NOW - timedelta(minutes=5), NOW - timedelta(minutes=5, seconds=-1))
    rate = activity.bronze_insert_rate({"t": df.withColumnRenamed("event_time_ms", "eventTimeMs")}, NOW)
    assert [(r["rows"], r["src"]) for r in rate.collect()] == [(2, "t")]
