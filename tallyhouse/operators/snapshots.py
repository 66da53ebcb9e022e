"""Dates and versions: partition choice, windows, increments."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.operators.sieve import MOST_BITS, bits_for, sieve_of, sifted


#: Bits of a sieve that each key needs, or too many rows pass for it to be worth its making.
BITS_OF_LATER = 2


# ------------------------------------------------------------ partition choice
@dataclass(frozen=True)
class Strategy:
    """How a dimension's snapshot is picked for a batch date."""

    name: str
    partitioned: bool = True
    use_latest_always: bool = False
    prefer_target_date: bool = True
    fallback_to_latest: bool = True


# ---- Fixed values: the strategies and the tables that use them -------------
STRATEGIES = {
    "daily": Strategy("daily"),
    "keep_history": Strategy("keep_history"),
    "latest_only": Strategy("latest_only", partitioned=False, use_latest_always=True, prefer_target_date=False),
}
TABLE_STRATEGY = {
    "Orders": "daily",
    "OrderDetails": "daily",
    "InventoryTransactions": "daily",
    "Customers": "keep_history",
    "Products": "keep_history",
    "Employees": "keep_history",
    "Warehouses": "latest_only",
    "Factories": "latest_only",
    "Inventory": "latest_only",
}


def resolve_partition(dates: Iterable[str] | None, target: str, strategy: Strategy) -> str | None:
    """The partition to read for ``target``, or None to read the table unfiltered.

    ``dates`` are the partitions the table has; None says it is not partitioned.
    """
    if not strategy.partitioned or dates is None:
        return None
    dates = list(dates)
    if not dates:
        return target
    if strategy.use_latest_always:
        return max(dates)
    if strategy.prefer_target_date and target not in dates and strategy.fallback_to_latest:
        return max(dates)
    return target


def resolve_partitions(targets: DataFrame, available: DataFrame, strategy: Strategy) -> DataFrame:
    """I6 for many batch dates at once: (target_date, resolved_date).

    Both inputs have one ``dt`` column of distinct dates, so their size is a number of days.
    """
    wanted = targets.select(F.col("dt").alias("target_date"))
    if not strategy.partitioned:
        return wanted.withColumn("resolved_date", F.lit(None).cast("string"))
    latest = available.agg(F.max("dt")).scalar()
    if strategy.use_latest_always:
        return wanted.withColumn("resolved_date", F.coalesce(latest, F.col("target_date")))
    if not (strategy.prefer_target_date and strategy.fallback_to_latest):
        return wanted.withColumn("resolved_date", F.col("target_date"))
    have = available.select(F.col("dt").alias("resolved_date"))
    exact = wanted.join(have, F.col("target_date") == F.col("resolved_date"), "left")
    return exact.withColumn("resolved_date", F.coalesce("resolved_date", latest, F.col("target_date")))


def drift_columns(target: str, resolved: str, warn: int = 3, error: int = 7) -> dict[str, Column]:
    """I8: days between the wanted and the chosen partition, and what that means."""
    days = F.abs(F.datediff(F.col(target).cast("date"), F.col(resolved).cast("date")))
    level = F.when(days >= error, "error").when(days >= warn, "warning").otherwise("ok")
    return {"drift_days": days, "drift_level": level}


def partition_drift(target: str, resolved: str | None, warn: int = 3, error: int = 7) -> tuple[int | None, str]:
    """I8 for one date on the driver."""
    if resolved is None:
        return None, "ok"
    days = abs((date.fromisoformat(target) - date.fromisoformat(resolved)).days)
    return days, "error" if days >= error else "warning" if days >= warn else "ok"


# ------------------------------------------------------------ stamps and windows
def stamp(df: DataFrame, as_of: str, col: str = "dt") -> DataFrame:
    """The run date as partition column."""
    return df.withColumn(col, F.lit(as_of))


def processing_date(df: DataFrame, as_of: str) -> DataFrame:
    """K21."""
    return df.withColumn("processing_date", F.lit(as_of).cast("date"))


def days_before(as_of: str, days: int) -> str:
    return (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()


def month_range(month: str) -> tuple[str, str]:
    """First day of ``yyyy-MM`` and first day of the month after it."""
    year, number = map(int, month.split("-"))
    following = date(year + number // 12, number % 12 + 1, 1)
    return date(year, number, 1).isoformat(), following.isoformat()


def window_by_dt(df: DataFrame, as_of: str, days: int = 30, part_col: str = "dt") -> DataFrame:
    """Partitions from ``days`` before the date up to the date, both included.

    For facts loaded by increments, where a partition holds that day's rows only.
    """
    return df.filter(F.col(part_col).between(days_before(as_of, days), as_of))


def latest_snapshot(
    df: DataFrame, as_of: str, part_col: str = "dt", dates: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the newest partition not after ``as_of``.

    For facts loaded as full snapshots: every order appears in every partition, so
    adding partitions up would count it many times.  With the table's ``dates`` at
    hand the choice is a literal and nothing has to be read to make it.
    """
    if dates is not None:
        newest = max((d for d in dates if d <= as_of), default=None)
        return df.filter(F.col(part_col) == F.lit(newest))
    known = df.filter(F.col(part_col) <= as_of)
    return known.filter(F.col(part_col) == known.agg(F.max(part_col)).scalar())


def in_month(df: DataFrame, month: str, date_col: str = "OrderDate") -> DataFrame:
    """P4 as a range on the date itself, which reaches the scan."""
    first, after = month_range(month)
    day = F.col(date_col)
    return df.filter((day >= F.lit(first).cast("date")) & (day < F.lit(after).cast("date")))


def last_days(df: DataFrame, as_of: str, days: int, date_col: str = "order_date") -> DataFrame:
    """Dates not older than ``days`` before the date, and none after it."""
    return df.filter(F.col(date_col).between(days_before(as_of, days), as_of))


# ------------------------------------------------------------ increments
def high_water_mark(df: DataFrame, col: str) -> DataFrame:
    """One row ``hwm``; NULL for an empty target."""
    return df.agg(F.max(col).alias("hwm"))


def delta(src: DataFrame, col: str, hwm: object | None, lookback_days: int = 0) -> DataFrame:
    """Rows changed after the mark; everything without a mark.

    ``lookback_days`` reads an overlap again for rows the source changed late.
    """
    if hwm is None:
        return src
    mark = F.lit(hwm)
    if lookback_days:
        mark = mark - F.make_dt_interval(F.lit(lookback_days))
    return src.filter(F.col(col) > mark)


def latest_per_key(df: DataFrame, keys: Iterable[str], *order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns, ties by the other columns.

    An aggregate, so rows of a frequent key are reduced before they are moved.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)


def latest_version(df: DataFrame, keys: Iterable[str], *order: str) -> DataFrame:
    """``latest_per_key`` of rows whose keys and ``order`` columns together occur once, so that no other column decides.

    Such as rows of loads that hold each key once, ordered by load in the end.  Only the columns that a reader takes are
    moved and sorted, and a key has a row per load at most.
    """
    later = F.lead(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__later", later).filter(F.col("__later").isNull()).drop("__later")


def latest_load(df: DataFrame, keys: Iterable[str], rows_of: Mapping[str, int], part_col: str = "dt") -> DataFrame:
    """``latest_version`` of rows ordered by their load alone, by the numbers of rows of the loads, which hold each key once.

    A row counts if no later load holds its key. Rows of the newest load do; those of the largest other one do unless a sieve
    of the later loads' keys holds theirs, and stay where they lie. The rest meet the keys of later loads, not their rows.
    """
    keys, loads = list(keys), sorted(rows_of)
    large = max(loads[:-1], key=lambda load: rows_of[load])
    later = sum(n for load, n in rows_of.items() if load > large)
    if BITS_OF_LATER * later > MOST_BITS:
        return latest_version(df, keys, part_col)
    of, bits = F.col(part_col), bits_for(later)
    sieve = sieve_of(df.filter(of.isin([load for load in loads if load > large])).select(*keys), bits)
    sure, unsure = sifted(df.filter(of == large), sieve, keys, bits)
    if rest := [load for load in loads[:-1] if load != large]:
        unsure = unsure.unionByName(df.filter(of.isin(rest)))
    newer = df.filter(of > loads[0]).select(*(F.col(k).alias(f"__{k}") for k in keys), of.alias("__load"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    # an outer join: Spark would take an anti join below the sieve and move all rows; merged: its estimate of the keys is low
    kept = unsure.join(newer.hint("merge"), same & (F.col("__load") > of), "left").filter(F.col("__load").isNull()).select(*df.columns)
    return df.filter(of == loads[-1]).unionByName(sure).unionByName(kept)


def upsert(target: DataFrame, changes: DataFrame, keys: Iterable[str], order_col: str) -> DataFrame:
    """The newest version of every changed row, and the target's other rows.

    A change older than the row the target holds is no news; of equal age, the change
    counts.  The target holds a key at most once, and its rows meet the changes only: few
    changes are broadcast and the target stays where it is.
    """
    keys, columns = list(keys), target.columns
    changed = latest_per_key(changes, keys, order_col).select(*columns)
    both = target.join(changed.select(*keys, F.struct(*columns).alias("__new")), keys, "left")
    age = F.col("__new")[order_col]
    newer = F.col("__new").isNotNull() & (F.col(order_col).isNull() | F.coalesce(age >= F.col(order_col), F.lit(False)))
    chosen = both.select(*(F.when(newer, F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in columns))
    return chosen.unionByName(changed.join(target.select(*keys), keys, "left_anti").select(*columns))
