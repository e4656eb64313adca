"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from workload.oracle import SQL
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, name, SF)
    assert ok, note


def test_days_come_in_order(spark):
    got = [(r.day, r.src) for r in entry.queries()["order_by"](spark, SF).collect()]
    assert got == sorted(got) and len({src for _, src in got}) == 2


def test_entry(spark):
    assert entry.entry(spark).count() == 15
