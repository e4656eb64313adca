"""Physical plans: pruned scans, no global windows, limits before shuffles."""

import re
from datetime import datetime

import pytest

from tidemark.operators import ingest, layout, ranking, series
from tidemark.plans import gold, overview, reconcile, silver
from tidemark.schemas import PRICES
from tidemark.session import configure, work_dir
from tidemark.sources import landing
from workload import feeds

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze_path(spark):
    path = work_dir(configure(spark), "bronze")
    layout.bronze_layout(feeds.bronze_prices(spark, SF), path)
    return path


def test_trailing_days_prune_partitions(spark, bronze_path):
    recent = landing.bronze_scan(spark, bronze_path, PRICES, datetime(2024, 1, 31), 7)
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(ingestion_date" in text and "ingestion_date#" in text
    assert len(recent.inputFiles()) >= 1
    assert recent.count() < landing.bronze_scan(spark, bronze_path, PRICES).count()


def test_retention_prunes_partitions(spark, bronze_path):
    kept = layout.retention(landing.bronze_scan(spark, bronze_path, PRICES), datetime(2025, 1, 15))
    assert re.search(r"PartitionFilters: \[[^]]*add_months", plan(kept))


def test_reconciliation_reads_only_what_it_compares(spark, bronze_path):
    rows = landing.bronze_scan(spark, bronze_path, PRICES)
    text = plan(reconcile.sink_validation(rows, rows, PRICES, datetime(2024, 1, 31)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("coinName" not in s and "symbol" not in s and "eventTimeMs" not in s for s in schemas)


def test_latest_state_limits_groups_before_the_shuffle(spark, bronze_path):
    rows = landing.bronze_scan(spark, bronze_path, PRICES)
    for df in (silver.silver_prices(rows), gold.dim_asset(rows), gold.fct_market_prices(rows)):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_gold_filters_reach_the_scan(spark, bronze_path):
    text = plan(gold.fct_market_prices(landing.bronze_scan(spark, bronze_path, PRICES)))
    assert "PushedFilters: [IsNotNull(op), Not(EqualTo(op,d))]" in text


def test_the_overview_joins_without_another_shuffle(spark, bronze_path):
    rows = landing.bronze_scan(spark, bronze_path, PRICES)
    prices = overview.latest_prices(gold.fct_market_prices(rows))
    caps = overview.latest_caps(gold.fct_market_caps(feeds.bronze_caps(spark, SF)))
    joined = overview.left_equi(prices, caps.hint("merge"))
    # two exchanges a side: facts by (asset, time), then per-asset partial results
    assert plan(joined).count("Exchange hashpartitioning") == 4
    assert "SortAggregate" not in plan(prices)


def test_totals_move_one_row(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(ranking.global_total(rows, {"whole": "value"}))
    assert "BroadcastNestedLoopJoin" in text and "Window" not in text


def test_a_large_rank_has_no_single_task_window_over_rows(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value")
    text = plan(ranking.market_cap_rank(rows, "value", "r"))
    over_all = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    # the one-row total and the one-row-per-range offsets
    assert len(over_all) == 2


def test_deltas_scan_staged_samples(spark):
    samples = feeds.topic_offsets(spark, SF)
    text = plan(series.counter_delta(samples))
    # chunks, summaries of chunks, and the order of chunks within a series
    assert text.count("Exchange hashpartitioning") <= 3 and "events.parquet" not in text


def test_holds_window_within_chunks(spark):
    text = plan(series.alert_hold(feeds.error_evaluations(spark, SF)))
    assert "Exchange SinglePartition" not in text
    for window in re.findall(r"Window \[.*?\], \[(.*?)\], \[", text):
        assert "_chunk" in window or "rule_uid" in window


def test_few_repeated_keys_move_no_rows(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = ingest.TableRules(required=("l_orderkey",), numeric=(), key=("l_orderkey", "l_linenumber"))
    text = plan(ingest.constraint_check(lines, rules))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
