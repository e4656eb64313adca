"""Totals, ranks and shares."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import ranking


@pytest.mark.parametrize("seed", range(3))
def test_ranges_rank_like_one_window(spark, seed):
    """A third of the rows hold one value, another part is null."""
    draw = random.Random(seed)
    value = lambda: draw.choice([500, None, draw.randrange(1000), draw.randrange(1000)])
    df = spark.createDataFrame([(i, value()) for i in range(3000)], "asset_id int, market_cap int")
    want = df.withColumn("r", F.rank().over(W.orderBy(F.desc_nulls_last("market_cap"))).cast("bigint"))
    assert rows(ranking.market_cap_rank(df, out="r")) == rows(want)


def test_all_null_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "asset_id int, market_cap int")
    assert rows(ranking.market_cap_rank(df, out="r")) == [(1, None, 1), (2, None, 1)]
    assert ranking.market_cap_rank(df.limit(0), out="r").count() == 0


def test_equal_caps_share_a_rank_then_a_gap(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", None)], "asset_id string, market_cap int")
    assert [r[2] for r in ranking.market_cap_rank(df).orderBy("asset_id").collect()] == [1, 1, 3, 4]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 1.0, 4.0), ("c", None, 4.0)], "k string, v double, w double")
    assert rows(ranking.share_of_total(df, "v", "w", "s").select("k", "s")) == [("a", None), ("b", 0.25), ("c", None)]
    assert {r.t for r in ranking.global_total(df, {"t": "w"}).collect()} == {8.0}


def test_a_page_has_k_rows_even_with_ties(spark):
    df = spark.createDataFrame([(f"a{i:03}", 7) for i in range(50)], "asset_id string, market_cap int")
    assert [r.asset_id for r in ranking.top_k_assets(df, 3).collect()] == ["a000", "a001", "a002"]
