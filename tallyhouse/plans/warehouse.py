"""The daily jobs: raw copies to cleaned facts to aggregate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import dwd, quality, summaries
from tallyhouse.operators.snapshots import (
    STRATEGIES,
    TABLE_STRATEGY,
    days_before,
    in_month,
    latest_load,
    latest_per_key,
    latest_snapshot,
    latest_version,
    month_range,
    partition_drift,
    resolve_partition,
    stamp,
    window_by_dt,
)
from tallyhouse.sinks import tables as sink
from tallyhouse.sinks.held import Held, dates_like, dates_of_keys, drop_described, holding_once, replace_and_describe, rows_between, rows_of


# What the partitions of a cleaned fact are described by
HELD = {"orders": Held("OrderDate", "OrderID"), "orderdetails": Held("OrderDate", "OrderID")}
# What tells the rows of a fact apart, raw or cleaned
ROW_KEYS = {
    "orders": ("OrderID",),
    "orderdetails": ("OrderDetailID",),
    "inventorytransactions": ("TransactionID",),
}
CHANGED = "UpdatedDate"
# Keys that are sent to every task, at most: some 50 MB
SENT_KEYS = 1_000_000
# Rows of loads that are compared as they are: fewer are moved sooner than sifted
FEW_ROWS = 1_000_000
# Lines of a window whose summaries are written one after another: what three of them move at once would fill the disk
MANY_ROWS = 100_000_000


@dataclass(frozen=True)
class Layout:
    """Database names, and whether facts are loaded as increments or as full snapshots.

    ``snapshots`` has no default, it must say how the facts were copied: the specs of
    ``sync.default_specs`` copy full snapshots, mode ``incremental`` copies increments.
    Aggregates and views read facts through ``recent`` and ``of_changed_days`` only, so each
    order or line counts once.  In increments a row copied again, because it changed or
    in an overlap, lies in several partitions; the newest version by change time, then by
    load, counts.  An order keeps its order date.  ``check`` fails a build whose dimensions hold a key twice,
    ``limits`` one whose rows break the limits of D1, and measures the tables written (K19); ``most_drift`` fails one that would take a
    dimension's snapshot of so many days before or after its date (I8).
    """

    ods: str = "ods"
    dwd: str = "dwd_db"
    dws: str = "dws_db"
    snapshots: bool = field(kw_only=True)
    window_days: int = 30
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: ROW_KEYS)
    check: bool = False
    limits: bool = False
    most_drift: int | None = None

    def database(self, name: str) -> str:
        return {"dwd": self.dwd, "dws": self.dws}.get(name.split("_")[0], self.ods)

    def keys_of(self, table: str) -> tuple[str, ...]:
        return self.keys[table.split(".")[-1].lower().removeprefix("dwd_")]

    def newest(self, rows: DataFrame, table: str, dates: Iterable[str] | None = None) -> DataFrame:
        """Each order or line once, of rows that come from the partitions ``dates``.

        If all of these hold each key once, as their descriptions say, versions differ by load: those of one load are
        all the newest, and of several only the columns that are read take part.  Otherwise all columns do.  Of many rows
        without a change time, those that no later load brings again are not moved.
        """
        order, keys = [c for c in (CHANGED, "dt") if c in rows.columns], self.keys_of(table)
        if dates is None or "dt" not in order or not set(dates) <= holding_once(rows.sparkSession, table, keys):
            return latest_per_key(rows, keys, *order)
        if len(set(dates)) < 2:
            return rows
        if order == ["dt"]:
            held = rows_of(rows.sparkSession, table, dates)
            if sum(held.values()) > FEW_ROWS:
                return latest_load(rows, keys, held)
        return latest_version(rows, keys, *order)

    def recent(self, spark: SparkSession, table: str, as_of: str) -> DataFrame:
        """The rows the aggregates and views of a date stand for, each order or line once."""
        fact = spark.table(table)
        if self.snapshots:
            return latest_snapshot(fact, as_of, dates=sink.list_partitions(spark, table))
        dates, first = sink.list_partitions(spark, table), days_before(as_of, self.window_days)
        dates = dates if dates is None else [d for d in dates if first <= d <= as_of]
        return self.newest(window_by_dt(fact, as_of, self.window_days), table, dates)

    def recent_in_month(self, spark: SparkSession, table: str, as_of: str, month: str) -> DataFrame:
        """The rows of ``recent`` that lie in a month, by order date.

        Only orders of which some version lies in the month are compared, all versions of these; if the descriptions
        of the loads say that they are few, their keys go to the rows.  Other rows are not moved then.
        """
        dates, first = sink.list_partitions(spark, table), days_before(as_of, self.window_days)
        dates = [d for d in dates or [] if first <= d <= as_of]
        held = None if self.snapshots or len(dates) < 2 else rows_between(spark, table, dates, *month_range(month))
        if held is None or held > SENT_KEYS:
            return in_month(self.recent(spark, table, as_of), month)
        rows, keys = window_by_dt(spark.table(table), as_of, self.window_days), self.keys_of(table)
        some = in_month(rows, month).select(*(F.col(k).alias(f"__{k}") for k in keys))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
        return in_month(self.newest(rows.join(F.broadcast(some), same, "left_semi"), table, dates), month)

    def of_changed_days(self, spark: SparkSession, table: str, as_of: str) -> DataFrame:
        """The rows of every order date the load of a date brings, each order or line once.

        Of a snapshot that is the load.  Increments bring late and changed orders of
        earlier dates, whose other orders lie in earlier loads.  Only loads that hold such a
        date are read, as their descriptions say; other rows leave in a semi join with the dates.
        """
        fact = spark.table(table)
        if self.snapshots:
            return fact.filter(F.col("dt") == as_of)
        day = F.col("OrderDate").cast("date")
        found = dates_like(spark, table, as_of)
        if found is not None:  # only the loads that hold one of these days are read
            days, dates = found
            near = fact.filter(F.col("dt").isin(dates))
        else:
            load = fact.filter(F.col("dt") == as_of)
            first, last = load.agg(F.min(day), F.max(day)).first()
            dates = None
            near = fact.filter((F.col("dt") <= as_of) & (day.between(F.lit(first), F.lit(last)) | day.isNull()))
            days = load.select(day.alias("__day")).distinct()
        return self.newest(near.join(days, day.eqNullSafe(F.col("__day")), "left_semi"), table, dates)


def held_of(layout: Layout, fact: str) -> Held:
    """What the partitions of a cleaned fact are described by: whether the layout's keys tell their rows apart, too."""
    return replace(HELD[fact], once=layout.keys[fact])


def dimension(spark: SparkSession, layout: Layout, name: str, batch_date: str) -> DataFrame:
    """The dimension's rows for a batch date, with a literal partition filter."""
    table = f"{layout.ods}.{name}"
    strategy = STRATEGIES[TABLE_STRATEGY[name]]
    dates = sink.list_partitions(spark, table)
    dt = resolve_partition(dates, batch_date, strategy)
    require_near(layout, table, batch_date, dt)
    rows = spark.table(table)
    return rows if dt is None else rows.filter(F.col("dt") == dt)


def require_near(layout: Layout, table: str, batch_date: str, dt: str | None) -> None:
    """I8."""
    if layout.most_drift is None:
        return
    days, level = partition_drift(batch_date, dt, error=layout.most_drift)
    if level == "error":
        raise ValueError(f"{table}: the snapshot of {dt} is {days} days from {batch_date}")


def batch(spark: SparkSession, layout: Layout, name: str, batch_date: str) -> DataFrame:
    """The fact rows of one load."""
    return spark.table(f"{layout.ods}.{name}").filter(F.col("dt") == batch_date)


def _nothing(spark: SparkSession, table: str, batch_date: str) -> None:
    """An empty load has no cleaned rows, those of an earlier run over it included."""
    if sink.table_exists(spark, table):
        drop_described(spark, table, [batch_date])


def build_dwd_orders(spark: SparkSession, batch_date: str, layout: Layout) -> sink.WriteResult | None:
    """Cleaned orders of one load; None if the load is empty."""
    orders, target = batch(spark, layout, "Orders", batch_date), f"{layout.dwd}.dwd_orders"
    if orders.isEmpty():
        return _nothing(spark, target, batch_date)
    customers, employees = (dimension(spark, layout, n, batch_date) for n in ("Customers", "Employees"))
    fact = dwd.dwd_orders(orders, customers, employees, batch_date=batch_date, check=layout.check)
    sink.ensure_database(spark, layout.dwd)
    done = replace_and_describe(stamp(fact, batch_date), target, held_of(layout, "orders")).require_complete()
    return _checked(spark, layout, done, [batch_date])


def _checked(spark: SparkSession, layout: Layout, done: sink.WriteResult, dates: list[str]) -> sink.WriteResult:
    """D1 over stored orders, and K19."""
    if layout.limits:
        stored = spark.table(done.table).filter(F.col("dt").isin(dates))
        broken = quality.validate_orders(stored).filter(~F.col("passed")).collect()
        if broken:
            raise ValueError(f"{done.table}: " + ", ".join(f"{r['check']} {r['value']:.3f} over {r['threshold']}" for r in broken))
        sink.refresh_and_analyze(spark, done.table, noscan=True)
    return done


def build_dwd_orders_range(spark: SparkSession, dates: Iterable[str], layout: Layout) -> sink.WriteResult | None:
    """Cleaned orders of many loads in one pass, as ``build_dwd_orders`` makes them one by one (I6, J3); None if all are empty.

    Each load's snapshot of a dimension is chosen on the driver, a name a date; rows meet the dimension by key and
    snapshot, so all snapshots wanted are read once.  A backfill moves its orders once, not once a day.
    """
    dates, target = sorted(set(dates)), f"{layout.dwd}.dwd_orders"
    orders = spark.table(f"{layout.ods}.Orders").filter(F.col("dt").isin(dates))
    if orders.isEmpty():
        for day in dates:
            _nothing(spark, target, day)
        return None
    dims = {}
    for name, key, own in (("Customers", "CustomerID", "CustomerID"), ("Employees", "CreatedBy", "EmployeeID")):
        orders, dims[name] = _by_snapshot(spark, layout, name, dates, orders, key, own)
    saved = {c: F.col(f"__{c}") for c in ("CustomerID", "CreatedBy")}
    fact = dwd.dwd_orders(orders, dims["Customers"], dims["Employees"], batch_date=F.col("dt"), check=layout.check)
    fact = fact.withColumns(saved).drop(*(f"__{c}" for c in saved))
    sink.ensure_database(spark, layout.dwd)
    done = replace_and_describe(fact, target, held_of(layout, "orders"), dates=dates, rebalance=True).require_complete()
    return _checked(spark, layout, done, dates)


def _by_snapshot(
    spark: SparkSession, layout: Layout, name: str, dates: list[str], orders: DataFrame, key: str, own: str
) -> tuple[DataFrame, DataFrame]:
    """The orders and a dimension, both with its key bound to the snapshot that the order's load takes."""
    table = f"{layout.ods}.{name}"
    held, strategy = sink.list_partitions(spark, table), STRATEGIES[TABLE_STRATEGY[name]]
    chosen = {day: resolve_partition(held, day, strategy) for day in dates}
    for day, dt in chosen.items():
        require_near(layout, table, day, dt)
    orders, rows = orders.withColumn(f"__{key}", F.col(key)), spark.table(table)
    if None in chosen.values():  # a table without snapshots
        return orders, rows
    bound = lambda dt, of: F.when(of.isNotNull(), F.concat(dt, F.lit("|"), of.cast("string")))
    snapshot = F.create_map(*(F.lit(x) for pair in chosen.items() for x in pair))[F.col("dt")]
    wanted = rows.filter(F.col("dt").isin(sorted(set(chosen.values()))))
    return orders.withColumn(key, bound(snapshot, F.col(key))), wanted.withColumn(own, bound(F.col("dt"), F.col(own)))


def known_orders(spark: SparkSession, layout: Layout, batch_date: str, details: DataFrame) -> DataFrame:
    """The orders the lines of a load belong to, each once.

    A snapshot holds all of them; of increments, every load up to the date counts whose orders
    may be among them, because a late line may belong to an old order: copies that are described
    (``TableSpec.held``) name these loads.  Other orders are left out before versions are compared, unless there are no more
    of them, by their descriptions, than lines.
    """
    if layout.snapshots:
        return dimension(spark, layout, "Orders", batch_date)
    table = f"{layout.ods}.Orders"
    keys = details.select("OrderID")
    dates = dates_of_keys(spark, table, keys, batch_date)
    loaded, held = spark.table(table).filter(F.col("dt").isin(dates)), rows_of(spark, table, dates)
    if set(dates) <= set(held) and sum(held.values()) <= details.count():
        return layout.newest(loaded, table, dates)
    return layout.newest(loaded.join(keys, "OrderID", "left_semi"), table, dates)


def build_dwd_orderdetails(spark: SparkSession, batch_date: str, layout: Layout) -> sink.WriteResult | None:
    """Cleaned order lines of one load; None if the load is empty."""
    details, target = batch(spark, layout, "OrderDetails", batch_date), f"{layout.dwd}.dwd_orderdetails"
    if details.isEmpty():
        return _nothing(spark, target, batch_date)
    names = ("Customers", "Products", "Warehouses", "Factories")
    dims = [known_orders(spark, layout, batch_date, details), *(dimension(spark, layout, n, batch_date) for n in names)]
    fact = dwd.dwd_orderdetails(details, *dims, batch_date=batch_date, check=layout.check)
    sink.ensure_database(spark, layout.dwd)
    return replace_and_describe(stamp(fact, batch_date), target, held_of(layout, "orderdetails")).require_complete()


def build_dws_orders(spark: SparkSession, as_of: str, layout: Layout) -> list[str]:
    """A1 - A3 for a date; returns the tables that got rows."""
    table = f"{layout.dwd}.dwd_orders"
    recent, changed = layout.recent(spark, table, as_of), layout.of_changed_days(spark, table, as_of)
    of_month = layout.recent_in_month(spark, table, as_of, as_of[:7])
    return _write(
        spark,
        layout,
        as_of,
        {
            "dws_orders_daily_summary": lambda: summaries.orders_daily_summary(changed),
            "dws_orders_monthly_summary": lambda: summaries.orders_monthly_summary(of_month, as_of[:7]),
            "dws_customer_analytics": lambda: summaries.customer_analytics(recent, as_of),
        },
    )


def build_dws_orderdetails(spark: SparkSession, as_of: str, layout: Layout) -> list[str]:
    """A4 - A6 for a date; returns the tables that got rows."""
    table = f"{layout.dwd}.dwd_orderdetails"
    recent, changed = layout.recent(spark, table, as_of), layout.of_changed_days(spark, table, as_of)
    return _write(
        spark,
        layout,
        as_of,
        {
            "dws_orderdetails_daily_summary": lambda: summaries.orderdetails_daily_summary(changed),
            "dws_product_analytics": lambda: summaries.product_analytics(recent),
            "dws_warehouse_analytics": lambda: summaries.warehouse_analytics(recent),
        },
        many=sum(rows_of(spark, table, sink.list_partitions(spark, table) or []).values()) > MANY_ROWS,
    )


def _write(
    spark: SparkSession, layout: Layout, as_of: str, made: dict[str, Callable[[], DataFrame]], many: bool = False
) -> list[str]:
    """The tables are independent of each other and written side by side, so that the last tasks of one leave no cores idle;
    those of ``many`` rows one after another, each takes all cores."""
    sink.ensure_database(spark, layout.dws)

    def write(name: str) -> bool:
        done = sink.replace_partitions(stamp(made[name](), as_of), f"{layout.dws}.{name}", dates=[as_of])
        if done.require_complete().rows and layout.limits:
            sink.refresh_and_analyze(spark, done.table, noscan=True)
        return done.rows > 0

    with ThreadPoolExecutor(max_workers=1 if many else len(made)) as workers:
        return [name for name, rows in zip(made, list(workers.map(write, made))) if rows]
