"""Daily states of the summaries, stored by order month and merged for a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import states, summaries
from tallyhouse.operators.snapshots import days_before
from tallyhouse.plans.warehouse import FEW_ROWS, Layout
from tallyhouse.sinks import tables as sink
from tallyhouse.sinks.held import dates_like, rows_of

#: Rows without an order date have a day and a month of their own.
NO_DAY = "none"
MONTH = "state_month"


def table_of(layout: Layout, name: str) -> str:
    return f"{layout.dws}.state_{name}"


def build_states(spark: SparkSession, as_of: str, layout: Layout, *names: str) -> list[str]:
    """Replaces the states of every order date that the load of a date brings; returns the tables written.

    An order keeps its order date, so a changed one changes the states of one day, which are worked out from
    the newest versions of that day's rows alone.  The first ones make the table.  Of later ones the months they lie in are
    written again, the states of their other days as they were.  If they come from many rows, by the descriptions of the loads, these
    name the days, and all is written at once; else the states are stored beside the table first and name their days.  Of a
    snapshot every day is written, and a month that it no longer holds goes.
    """
    sink.ensure_database(spark, layout.dws)
    written = []
    for name, kind in states.kinds().items():
        fact, target = f"{layout.dwd}.{kind.fact}", table_of(layout, name)
        if names and name not in names or not sink.table_exists(spark, fact):
            continue
        beside = f"{target}__delta"
        found = states.states(layout.of_changed_days(spark, fact, as_of), kind)
        found = found.withColumn(states.DAY, F.coalesce(states.DAY, F.lit(NO_DAY)))
        found = found.withColumn(MONTH, F.when(F.col(states.DAY) == NO_DAY, NO_DAY).otherwise(F.substring(states.DAY, 1, 7)))
        sink.drop_objects(spark, tables=[beside])
        if not sink.table_exists(spark, target):
            sink.replace_partitions(found, target, part_col=MONTH, rebalance=True).require_complete()
            written.append(name)
            continue
        days = None if layout.snapshots else days_of_many(spark, fact, as_of)
        if days is not None:
            months = sorted({day[:7] if day != NO_DAY else NO_DAY for day in days})
            kept = spark.table(target).filter(F.col(MONTH).isin(months)).join(F.broadcast(days_frame(spark, days)), states.DAY, "left_anti")
            sink.replace_partitions(found.unionByName(kept), target, part_col=MONTH, rebalance=True, dates=months).require_complete()
            written.append(name)
            continue
        sink.write_table(found, beside).require_complete()  # rows of an aggregate, in tasks of the advised size
        new, old = spark.table(beside), []
        if layout.snapshots:
            old = sink.list_partitions(spark, target, MONTH)
        else:
            months = [r[0] for r in new.select(MONTH).distinct().collect()]
            kept = spark.table(target).filter(F.col(MONTH).isin(months))
            new = new.unionByName(kept.join(new.select(states.DAY).distinct(), states.DAY, "left_anti"))
        sink.replace_partitions(new, target, part_col=MONTH, rebalance=True, dates=old).require_complete()
        sink.drop_objects(spark, tables=[beside])
        written.append(name)
    return written


def days_of_many(spark: SparkSession, fact: str, as_of: str) -> list[str] | None:
    """The days that a load brings, by the descriptions, if all loads hold many rows of them; else None."""
    found = dates_like(spark, fact, as_of)
    if found is None or sum(rows_of(spark, fact, found[1]).values()) <= FEW_ROWS:
        return None
    return [r[0] for r in found[0].select(F.coalesce(F.date_format("__day", "yyyy-MM-dd"), F.lit(NO_DAY))).collect()]


def days_frame(spark: SparkSession, days: list[str]) -> DataFrame:
    return spark.createDataFrame([(day,) for day in days], f"{states.DAY} string")


def held_states(spark: SparkSession, name: str, as_of: str, layout: Layout, days: int | None = None) -> DataFrame:
    """The states up to a date, of so many days before it or of all; rows without a day count in the latter only."""
    of = spark.table(table_of(layout, name)).drop(MONTH)
    day, month = F.col(states.DAY), F.col(MONTH)
    if days is not None:
        first = days_before(as_of, days)
        return spark.table(table_of(layout, name)).filter(month.between(first[:7], as_of[:7]) & day.between(first, as_of)).drop(MONTH)
    return of.filter((day <= as_of) | (day == NO_DAY))


def monthly_summary(spark: SparkSession, as_of: str, layout: Layout, days: int | None = None) -> DataFrame:
    of = held_states(spark, "monthly", as_of, layout, days)
    month = F.when(F.col(states.DAY) != NO_DAY, F.substring(states.DAY, 1, 7)).alias("year_month")
    return summaries.monthly_rates(states.merged(of, states.kinds()["monthly"], month))


def customer_analytics(spark: SparkSession, as_of: str, layout: Layout, days: int | None = None) -> DataFrame:
    of = held_states(spark, "customers", as_of, layout, days)
    return summaries.customer_profile(states.merged(of, states.kinds()["customers"]), as_of)


def product_analytics(spark: SparkSession, as_of: str, layout: Layout, days: int | None = None) -> DataFrame:
    of = held_states(spark, "products", as_of, layout, days)
    return summaries.product_profile(states.merged(of, states.kinds()["products"]))


def warehouse_analytics(spark: SparkSession, as_of: str, layout: Layout, days: int | None = None) -> DataFrame:
    """Distinct counts are estimates of merged sketches."""
    of = held_states(spark, "warehouses", as_of, layout, days)
    return summaries.warehouse_profile(states.merged(of, states.kinds()["warehouses"]))
