"""What each copy of a table read and wrote, by date: closed intervals and resumed runs.

A table ``sync_ledger`` in the target's database, one partition a target, one row a date:
the interval (low, high] of the change column that the date stands for, fixed before anything is read;
rows, digest and state of the copy.  A repeated run takes the interval of the first one.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sinks import tables as sink

NAME = "sync_ledger"
SCHEMA = "dt string, low string, high string, rows long, digest string, state string, target string"
STARTED, COMPLETE = "started", "complete"
_lock = threading.Lock()


@dataclass(frozen=True)
class Entry:
    """One copy; marks are texts of the change column's values, None where there is no bound."""

    target: str
    dt: str
    low: str | None = None
    high: str | None = None
    rows: int | None = None
    digest: str | None = None
    state: str = STARTED


def table_of(target: str) -> str:
    return ".".join([*target.split(".")[:-1], NAME])


def entries(spark: SparkSession, target: str) -> list[Entry]:
    """The copies of a target by date: as many rows as it has dates."""
    if not sink.table_exists(spark, table_of(target)):
        return []
    rows = spark.table(table_of(target)).filter(F.col("target") == target).orderBy("dt").collect()
    return [Entry(r["target"], r["dt"], r["low"], r["high"], r["rows"], r["digest"], r["state"]) for r in rows]


def entry(spark: SparkSession, target: str, as_of: str) -> Entry | None:
    return next((e for e in entries(spark, target) if e.dt == as_of), None)


def record(spark: SparkSession, new: Entry) -> Entry:
    """Stores an entry in place of an earlier one of its date; other targets are not touched."""
    kept = [*(e for e in entries(spark, new.target) if e.dt != new.dt), new]
    rows = [(e.dt, e.low, e.high, e.rows, e.digest, e.state, e.target) for e in kept]
    with _lock:  # the first one makes the table
        sink.replace_partitions(spark.createDataFrame(rows, SCHEMA).coalesce(1), table_of(new.target), part_col="target").require_complete()
    return new


def interval(spark: SparkSession, target: str, as_of: str, source: DataFrame, inc_col: str, held: object | None) -> Entry:
    """The interval of a date, fixed and stored by its first run.

    It begins where the interval of the date before ended, or at the mark ``held`` of a target without
    earlier entries, and ends at the newest change the source has now.
    """
    known = entries(spark, target)
    own = next((e for e in known if e.dt == as_of), None)
    if own is not None and own.high is not None:
        return own if own.state == STARTED else record(spark, replace(own, state=STARTED))
    before = [e.high for e in known if e.dt < as_of and e.high is not None]
    low = before[-1] if before else None if held is None else spark.range(1).select(F.lit(held).cast("string")).first()[0]
    high = source.agg(F.max(inc_col).cast("string")).first()[0]
    return record(spark, Entry(target, as_of, low, low if high is None else high))


def bounds(source: DataFrame, inc_col: str, of: Entry, lookback_days: int = 0) -> tuple[object | None, object | None]:
    """The bounds of an interval as values of the change column's type, the lower one set back by an overlap."""
    kind = source.schema[inc_col].dataType
    low, high = (F.lit(mark).cast(kind) for mark in (of.low, of.high))
    if lookback_days:
        low = (low - F.make_dt_interval(F.lit(lookback_days))).cast(kind)
    return tuple(source.sparkSession.range(1).select(low, high).first())


def within(source: DataFrame, inc_col: str, of: Entry, lookback_days: int = 0) -> DataFrame:
    """The rows of an interval; without a lower bound also those without a change time."""
    low, high = bounds(source, inc_col, of, lookback_days)
    col, rows = F.col(inc_col), source
    if low is not None:
        rows = rows.filter(col > F.lit(low))
    if high is not None:
        upto = col <= F.lit(high)
        rows = rows.filter(upto if low is not None else upto | col.isNull())
    return rows
