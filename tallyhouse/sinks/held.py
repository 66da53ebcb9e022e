"""What the partitions of a fact hold, in a small table beside it, so that readers name the partitions they need.

``<name>__held`` has a row per partition and date of the rows in it: the date, its rows, its least and greatest
key, and in ``once`` the columns that tell all rows of the partition apart, if they do. The write that replaces a partition replaces its rows there. Partitions without a description are always read, so a
table that was written otherwise is read whole, never in part.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyhouse.sinks import tables as sink

#: Parts of a range of keys that are told apart, at most.
CELLS = 10_000


@dataclass(frozen=True)
class Held:
    """The columns that are described: a date and a whole-number key; ``once`` are columns that may tell the rows apart."""

    day: str
    key: str
    once: tuple[str, ...] = ()


def table_of(name: str) -> str:
    return f"{name}__held"


def describe(spark: SparkSession, name: str, dates: Iterable[str], of: Held, part_col: str = "dt") -> None:
    """Replaces the description of some partitions by what is stored in them now."""
    dates, fact = list(dates), spark.table(name)
    key = F.col(of.key).cast("long") if isinstance(fact.schema[of.key].dataType, IntegralType) else F.lit(None).cast("long")
    found = fact.filter(F.col(part_col).isin(dates)).groupBy(F.col(of.day).cast("date").alias("day"), part_col)
    rows = found.agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest"))
    once = F.lit(None).cast("string")
    if of.once and {*of.once} <= {*fact.columns}:
        again = repeated(fact.filter(F.col(part_col).isin(dates)), of.once, part_col)
        once = F.when(~F.col(part_col).isin(again), ",".join(of.once))
    rows = sink.evolve_schema(spark, rows.coalesce(1).withColumn("once", once), table_of(name))  # older ones lack a column
    sink.replace_partitions(rows, table_of(name), part_col=part_col, dates=dates).require_complete()


def repeated(rows: DataFrame, keys: Iterable[str], part_col: str = "dt") -> list[str]:
    """The partitions that hold a key twice, missing keys included.  Hashes of the keys are compared first: as a rule no two are equal."""
    hashes = rows.groupBy(F.xxhash64(part_col, *keys).alias("__hash")).agg(F.count(F.lit(1)).alias("__rows"))
    with sink.released_shuffles(rows.sparkSession):
        if hashes.filter(F.col("__rows") > 1).isEmpty():
            return []
    twice = rows.groupBy(part_col, *keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > 1)
    with sink.released_shuffles(rows.sparkSession):
        return [r[0] for r in twice.select(part_col).distinct().collect()]


def replace_and_describe(df: DataFrame, name: str, of: Held, *, part_col: str = "dt", dates: Iterable[str] = (), **options) -> sink.WriteResult:
    """``replace_partitions`` of a fact, and the description of the partitions it wrote."""
    dates = list(dates)
    done = sink.replace_partitions(df, name, part_col=part_col, dates=dates, **options)
    describe(df.sparkSession, name, {*done.partitions, *dates} - {None}, of, part_col)
    return done


def drop_described(spark: SparkSession, name: str, dates: Iterable[str], part_col: str = "dt") -> None:
    dates = list(dates)
    sink.drop_partitions(spark, name, dates, part_col)
    if sink.table_exists(spark, table_of(name)):
        sink.drop_partitions(spark, table_of(name), dates, part_col)


def described(spark: SparkSession, name: str, part_col: str = "dt") -> tuple[DataFrame | None, set[str]]:
    """The description of a table and the partitions it covers."""
    if not sink.table_exists(spark, table_of(name)):
        return None, set()
    return spark.table(table_of(name)), set(sink.list_partitions(spark, table_of(name), part_col) or [])


def holding_once(spark: SparkSession, name: str, keys: Iterable[str], part_col: str = "dt") -> set[str]:
    """The partitions of a table that hold each key once, as their descriptions say."""
    table, _ = described(spark, name, part_col)
    if table is None or "once" not in table.columns:
        return set()
    told = F.coalesce(F.col("once") == ",".join(keys), F.lit(False))
    return {r[0] for r in table.groupBy(part_col).agg(F.min(told).alias("told")).filter("told").collect()}


def _chosen(spark: SparkSession, name: str, upto: str, known: set[str], hit: Iterable[str], part_col: str) -> list[str]:
    hit = set(hit)
    return [d for d in sink.list_partitions(spark, name, part_col) or [] if d <= upto and (d in hit or d not in known)]


def dates_like(spark: SparkSession, name: str, as_of: str, part_col: str = "dt") -> tuple[DataFrame, list[str]] | None:
    """The days that a partition holds, and the partitions up to it that hold any of them; None if it is not described."""
    table, known = described(spark, name, part_col)
    if table is None or as_of not in known:
        return None
    days = table.filter(F.col(part_col) == as_of).select(F.col("day").alias("__day")).distinct()
    hit = table.filter(F.col(part_col) <= as_of).join(F.broadcast(days), F.col("day").eqNullSafe(F.col("__day")), "left_semi")
    return days, _chosen(spark, name, as_of, known, (r[0] for r in hit.select(part_col).distinct().collect()), part_col)


def rows_between(spark: SparkSession, name: str, dates: Iterable[str], first: str, after: str, part_col: str = "dt") -> int | None:
    """The rows of some partitions from a day up to another one, which is left out; None if a partition is not described."""
    table, known = described(spark, name, part_col)
    if table is None or not set(dates) <= known:
        return None
    day = F.col("day")
    near = table.filter(F.col(part_col).isin(list(dates)) & (day >= F.lit(first).cast("date")) & (day < F.lit(after).cast("date")))
    return near.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def rows_of(spark: SparkSession, name: str, dates: Iterable[str], part_col: str = "dt") -> dict[str, int]:
    """The rows of those partitions that are described."""
    table, _ = described(spark, name, part_col)
    if table is None:
        return {}
    return {r[0]: r[1] for r in table.filter(F.col(part_col).isin(list(dates))).groupBy(part_col).agg(F.sum("rows")).collect()}


def dates_of_keys(spark: SparkSession, name: str, keys: DataFrame, upto: str, part_col: str = "dt", cells: int = CELLS) -> list[str]:
    """The partitions up to a date whose range of keys holds a key of the column ``keys``, told apart by ``cells`` parts
    of the range of all keys: never one too few."""
    table, known = described(spark, name, part_col)
    key = F.col(f"`{keys.columns[0]}`")
    if table is None or not isinstance(keys.schema[0].dataType, IntegralType):
        return _chosen(spark, name, upto, set(), (), part_col)
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return _chosen(spark, name, upto, known, (), part_col)
    width = (high - low) // cells + 1
    held = sorted(r[0] for r in keys.filter(key.isNotNull()).select(F.floor((key - low) / width).cast("long")).distinct().collect())
    ranges = table.filter(F.col(part_col) <= upto).groupBy(part_col).agg(F.min("least"), F.max("greatest"), F.count(F.when(F.col("least").isNull(), 1)))

    def meets(least: int | None, greatest: int | None, unknown: int) -> bool:
        if least is None or unknown and greatest is None:
            return True
        at = bisect_left(held, (least - low) // width)
        return at < len(held) and held[at] <= (greatest - low) // width

    return _chosen(spark, name, upto, known, (d for d, *of in ranges.collect() if meets(*of)), part_col)
