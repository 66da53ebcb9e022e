"""Partition choice, windows and increments."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import rollups, snapshots, summaries, views
from tallyhouse.operators.snapshots import STRATEGIES, Strategy, resolve_partition

DAILY, LATEST = STRATEGIES["daily"], STRATEGIES["latest_only"]
CHOICES = [
    (["2020-01-01"], "2020-01-01", LATEST, None),
    (None, "2020-01-01", DAILY, None),
    ([], "2020-01-01", DAILY, "2020-01-01"),
    (["2020-01-01", "2020-01-03"], "2020-01-01", DAILY, "2020-01-01"),
    (["2020-01-01", "2020-01-03"], "2020-01-02", DAILY, "2020-01-03"),
    (["2020-01-01"], "2020-01-02", Strategy("x", use_latest_always=True), "2020-01-01"),
    (["2020-01-01"], "2020-01-02", Strategy("x", fallback_to_latest=False), "2020-01-02"),
]


@pytest.mark.parametrize("dates, target, strategy, expected", CHOICES)
def test_resolve(dates, target, strategy, expected):
    assert resolve_partition(dates, target, strategy) == expected


@pytest.mark.parametrize("dates, target, strategy, expected", [c for c in CHOICES if c[0] is not None])
def test_resolve_as_a_join(spark, dates, target, strategy, expected):
    targets = spark.createDataFrame([(target,)], "dt string")
    available = spark.createDataFrame([(d,) for d in dates], "dt string")
    assert snapshots.resolve_partitions(targets, available, strategy).first()["resolved_date"] == expected


@pytest.mark.parametrize("resolved, level", [("2020-01-08", "ok"), ("2020-01-07", "warning"), ("2020-01-03", "error")])
def test_drift(spark, resolved, level):
    assert snapshots.partition_drift("2020-01-10", resolved)[1] == level
    row = spark.createDataFrame([("2020-01-10", resolved)], "t string, r string")
    assert row.withColumns(snapshots.drift_columns("t", "r")).first()["drift_level"] == level


def test_window_has_both_ends(spark):
    days = spark.createDataFrame([(f"2020-01-{d:02}",) for d in range(1, 32)] + [("2020-02-01",)], "dt string")
    assert snapshots.window_by_dt(days, "2020-01-31", 30).count() == 31


def test_snapshots_count_each_order_once(spark):
    loads = spark.createDataFrame(
        [(i, date(2020, 1, 1), 10.0, dt) for i in range(4) for dt in ("2020-01-01", "2020-01-02", "2020-01-09")],
        "id int, OrderDate date, amount double, dt string",
    )
    for dates in (None, ["2020-01-01", "2020-01-02", "2020-01-09"]):
        newest = snapshots.latest_snapshot(loads, "2020-01-05", dates=dates)
        assert {r["dt"] for r in newest.collect()} == {"2020-01-02"}
        assert rollups.orders_by_date(newest, "OrderDate").first()["order_count"] == 4
    assert snapshots.latest_snapshot(loads, "2019-01-01", dates=["2020-01-01"]).isEmpty()


def test_month_filter_reaches_december(spark):
    assert snapshots.month_range("2020-12") == ("2020-12-01", "2021-01-01")
    days = spark.createDataFrame([(date(2020, 11, 30),), (date(2020, 12, 1),), (date(2020, 12, 31),)], "OrderDate date")
    assert snapshots.in_month(days, "2020-12").count() == 2


CHANGES = "id int, state string, changed timestamp"


def at(hour):
    return datetime(2020, 1, 1, hour)


def test_delta_is_strict_and_full_without_a_mark(spark):
    rows = spark.createDataFrame([(1, "a", at(1)), (2, "b", at(2)), (3, "c", at(3))], CHANGES)
    assert {r["id"] for r in snapshots.delta(rows, "changed", at(2)).collect()} == {3}
    assert snapshots.delta(rows, "changed", None).count() == 3
    assert snapshots.delta(rows, "changed", datetime(2020, 1, 2, 1), lookback_days=1).count() == 2
    assert snapshots.high_water_mark(rows, "changed").first()["hwm"] == at(3)
    assert snapshots.high_water_mark(rows.limit(0), "changed").first()["hwm"] is None


def test_upsert_takes_the_newest_version(spark):
    target = spark.createDataFrame([(1, "old", at(1)), (2, "kept", at(1))], CHANGES)
    changes = spark.createDataFrame(
        [(1, "mid", at(2)), (1, "new", at(3)), (3, "added", at(2)), (3, "added", at(2))], CHANGES
    )
    once = snapshots.upsert(target, changes, ["id"], "changed")
    expected = {(1, "new"), (2, "kept"), (3, "added")}
    assert {(r["id"], r["state"]) for r in once.collect()} == expected and once.count() == 3
    again = snapshots.upsert(once, changes, ["id"], "changed")
    assert {(r["id"], r["state"]) for r in again.collect()} == expected


def test_upsert_keeps_a_newer_row_over_an_older_change(spark):
    target = spark.createDataFrame([(1, "new", at(5)), (2, "same", at(2))], CHANGES)
    changes = spark.createDataFrame([(1, "old", at(3)), (2, "change", at(2))], CHANGES)
    got = {(r["id"], r["state"]) for r in snapshots.upsert(target, changes, ["id"], "changed").collect()}
    assert got == {(1, "new"), (2, "change")}


def test_days_after_the_date_are_left_out(spark):
    days = spark.createDataFrame([(f"2024-01-0{d}",) for d in range(1, 10)], "order_date string")
    got = [r[0] for r in snapshots.last_days(days, "2024-01-03", 1).collect()]
    assert got == ["2024-01-02", "2024-01-03"]


def test_trend_reads_one_row_per_date(spark):
    daily = spark.createDataFrame(
        [("2020-01-01", 1, "2020-01-01"), ("2020-01-01", 5, "2020-01-02"), ("2020-01-02", 7, "2020-01-02")],
        "order_date string, total_orders int, dt string",
    ).withColumns({c: F.lit(1.0) for c in ("total_amount", "completion_rate", "delay_rate")})
    got = {r["order_date"]: (r["total_orders"], r["prev_day_orders"]) for r in views.orders_trend(daily).collect()}
    assert got == {"2020-01-01": (5, None), "2020-01-02": (7, 5)}
    earlier = views.orders_trend(daily, "2020-01-01").collect()
    assert [(r["order_date"], r["total_orders"]) for r in earlier] == [("2020-01-01", 1)]
    shown = views.orders_trend(daily, "2020-01-02", days=0).collect()
    assert [(r["order_date"], r["prev_day_orders"]) for r in shown] == [("2020-01-02", None)]


def test_daily_summary_over_many_loads(spark):
    rows = spark.createDataFrame([("2020-01-01", date(2020, 1, 1)), ("2020-01-02", date(2020, 1, 1))], "dt string, OrderDate date")
    by_load = summaries.by_day(rows, {"n": F.count(F.lit(1))}, ("dt",))
    assert {tuple(r) for r in by_load.collect()} == {("2020-01-01", "2020-01-01", 1), ("2020-01-02", "2020-01-01", 1)}
