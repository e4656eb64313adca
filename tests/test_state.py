"""Latest state, merging, replacing and null-skipping."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import state
from tidemark.plans import gold, silver
from tidemark.schemas import PRICES, bronze_schema

SCHEMA = "assetId string, lsn bigint, eventTimeMs bigint, price int, op string"


def events(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def latest(df):
    return state.partial_state(df, ["price", "op"])


def test_ties_are_ordered_by_time_then_payload(spark):
    df = events(spark, ("a", 5, 1, 9, "u"), ("a", 5, 2, 1, "u"), ("a", 5, 2, None, "u"), ("a", 4, 99, 99, "u"))
    assert rows(latest(df)) == [("a", 5, 2, 1, "u")]


def test_a_null_in_the_newest_row_stays_null(spark):
    df = events(spark, ("a", 1, 1, 7, "u"), ("a", 2, 2, None, "u"))
    assert rows(latest(df)) == [("a", 2, 2, None, "u")]
    assert rows(state.latest_nonnull_by_time(df, ["assetId"], ["price"], ["eventTimeMs"])) == [("a", 7)]


def test_nothing_known_is_null(spark):
    df = events(spark, ("a", 1, 1, None, "u"))
    assert rows(state.latest_nonnull_by_time(df, ["assetId"], ["price"], ["eventTimeMs", "lsn"])) == [("a", None)]


def test_delete_then_insert_again(spark):
    gone = events(spark, ("a", 1, 1, 1, "c"), ("a", 2, 2, 1, "d"))
    back = gone.unionByName(events(spark, ("a", 3, 3, 2, "c")))
    assert state.live(latest(gone)).count() == 0
    assert rows(state.live(latest(back))) == [("a", 3, 3, 2, "c")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from("abc"), st.integers(0, 4), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("cud")
        ),
        min_size=1,
        max_size=25,
    ),
    seed=st.integers(0, 1000),
)
def test_any_split_merges_to_the_whole(spark, data, seed):
    whole = events(spark, *data)
    draw = random.Random(seed)
    parts = [[], [], []]
    for row in data:
        for n in {draw.randrange(3), draw.randrange(3)}:  # some rows arrive twice
            parts[n].append(row)
    merged = state.state_merge(*[latest(events(spark, *part)) for part in parts])
    assert rows(merged) == rows(latest(whole))


def test_replacing_is_idempotent(spark):
    df = events(spark, ("a", 1, 1, 1, "c"), ("a", 2, 1, 2, "u"), ("b", 1, 1, 3, "c"), ("a", 2, 2, 4, "u"))
    once = state.replacing_dedup(df, ["assetId", "eventTimeMs"], "lsn")
    assert rows(once) == [("a", 2, 1, 2, "u"), ("a", 2, 2, 4, "u"), ("b", 1, 1, 3, "c")]
    assert rows(state.replacing_dedup(once, ["assetId", "eventTimeMs"], "lsn")) == rows(once)


@pytest.fixture(scope="module")
def history(spark):
    """One asset inserted, changed and deleted, in bronze shape."""
    data = [("a", 1, 1000, "c", "Old"), ("a", 2, 2000, "u", "New"), ("a", 3, 3000, "d", "Gone"), ("a", 4, 2000, "u", "Newer")]
    df = spark.createDataFrame(data, "assetId string, lsn bigint, eventTimeMs bigint, op string, coinName string")
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in bronze_schema(PRICES)]
    )


def test_gold_keeps_history_that_silver_hides(spark, history):
    before = history.filter("lsn < 4")
    assert silver.silver_prices(before).count() == 0
    assert gold.dim_asset(before).first().coin_name == "New"
    assert gold.fct_market_prices(before).count() == 2


def test_a_later_version_replaces_a_fact(spark, history):
    facts = gold.fct_market_prices(history)
    assert rows(facts.select("event_time_ms", "lsn")) == [(1000, 1), (2000, 4)]
    assert rows(facts.select("event_month").distinct()) == [("197001",)]


def test_keys_can_be_widened(spark, history):
    pounds = history.withColumn("currency", F.lit("gbp"))
    both = history.withColumn("currency", F.lit("usd")).unionByName(pounds)
    assert silver.latest_state(both, PRICES).count() == 1
    assert silver.latest_state(both, PRICES, ["assetId", "currency"]).count() == 2
