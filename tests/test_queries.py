"""Every registered query against its SQL, over whole tables."""

from functools import lru_cache

import pytest

import __spark_entry__ as entry
from registry import jobs
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def stored_once():
    """Queries that read the same stored loads share them here; by themselves each stores its own."""
    names = ("daily_jobs", "line_jobs", "order_states")
    plain = {name: getattr(jobs, name) for name in names}
    for name, make in plain.items():
        setattr(jobs, name, lru_cache(make))
    yield
    for name, make in plain.items():
        setattr(jobs, name, make)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, duck, name):
    assert compare.differences(entry.queries()[name](spark, SF_DIR), duck, ORACLES[name]) is None


SHUFFLED = [
    "dwd_orders",
    "dwd_orderdetails",
    "customer_analytics",
    "warehouse_analytics",
    "warehouse_efficiency",
    "dim_snapshot_join",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_equal_when_no_dimension_can_be_broadcast(spark, duck, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.differences(entry.queries()[name](spark, SF_DIR), duck, ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[0] == "order_date" and rows.count() > 0
