"""Registered queries over the daily jobs: tables stored load by load, then read as a user of the jobs reads them.

Three loads hold all orders.  Of increments, the first brings the orders before 2001, those of
2000 in an early state and those without a required date not yet; the second brings the rest; the
third brings the orders of 2000 again, as they are now.  A snapshot holds all orders known on its
date.  After the third load both stand for the source, whatever is stored.

Every call stores its tables in databases of its own, in the warehouse all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from registry.queries import AS_OF, COPIED, lines_fact, ods, query, rounded
from tallyhouse.operators import quality
from tallyhouse.operators import views as order_views
from tallyhouse.plans import reports as report_plan
from tallyhouse.plans import states, sync, views, warehouse
from tallyhouse.plans.sync import TableSpec
from tallyhouse.sinks import tables as sinks
from tallyhouse.sinks.buckets import upserted
from tallyhouse.sinks.held import Held, replace_and_describe

LOADS = ("2001-07-30", "2001-07-31", AS_OF)
KEYS = {"orders": ("OrderID",), "orderdetails": ("OrderDetailID",)}


def new_layout(snapshots: bool) -> warehouse.Layout:
    tag = uuid.uuid4().hex[:12]
    return warehouse.Layout(f"ods_{tag}", f"dwd_{tag}", f"dws_{tag}", snapshots=snapshots, keys=KEYS)


def store(rows: DataFrame, layout: warehouse.Layout, name: str, day: str) -> None:
    sinks.ensure_database(rows.sparkSession, layout.ods)
    target, dated = f"{layout.ods}.{name}", rows.withColumn("dt", F.lit(day))
    if name == "Orders":
        replace_and_describe(dated, target, Held("OrderDate", "OrderID", once=KEYS["orders"]))
    else:
        sinks.replace_partitions(dated, target)


def order_loads(spark: SparkSession, sf: str, snapshots: bool) -> dict[str, DataFrame]:
    orders = ods(spark, sf, "orders")
    changed = F.year("OrderDate") == 2000
    first = (F.year("OrderDate") < 2001) & F.col("RequiredDate").isNotNull()
    early = orders.withColumn("Status", F.when(changed, "Processing").otherwise(F.col("Status")))
    if snapshots:
        return dict(zip(LOADS, (early.filter(first), early, orders)))
    return dict(zip(LOADS, (early.filter(first), early.filter(~first), orders.filter(changed))))


def daily_jobs(spark: SparkSession, sf: str, snapshots: bool) -> warehouse.Layout:
    """All loads stored and run through the jobs."""
    layout = new_layout(snapshots)
    for name in ("Customers", "Employees"):
        store(ods(spark, sf, name.lower()), layout, name, LOADS[0])
    for day, rows in order_loads(spark, sf, snapshots).items():
        store(rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
        warehouse.build_dws_orders(spark, day, layout)
    return layout


def line_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their order's load as ``dt``, each with an id of its own; the third load brings the lines of 2000 again, those
    of the first one included, whose orders lie in an older load.  All loads come from one pass over the lines."""
    numbered = Window.partitionBy("OrderID", "LineNumber").orderBy("ProductID", "WarehouseID", "Quantity", "UnitPrice", "Discount", "Status")
    own = F.concat_ws("-", "OrderID", "LineNumber", F.row_number().over(numbered))
    # dealt by order, so that they are numbered and meet their orders where they lie
    lines = ods(spark, sf, "orderdetails").repartition("OrderID").withColumn("OrderDetailID", own)
    orders = ods(spark, sf, "orders").select("OrderID", F.year("OrderDate").alias("__year"), F.col("RequiredDate").isNotNull().alias("__known"))
    placed = lines.join(orders, "OrderID", "left")
    changed, first = F.coalesce(F.col("__year") == 2000, F.lit(False)), F.coalesce((F.col("__year") < 2001) & F.col("__known"), F.lit(False))
    early = F.struct(F.when(first, LOADS[0]).otherwise(LOADS[1]).alias("dt"), F.when(changed, "Backorder").otherwise(F.col("Status")).alias("Status"))
    again = F.struct(F.lit(LOADS[2]).alias("dt"), F.col("Status").alias("Status"))
    loads = placed.withColumn("__load", F.explode(F.when(changed, F.array(early, again)).otherwise(F.array(early))))
    return loads.withColumns({"Status": F.col("__load.Status"), "dt": F.col("__load.dt")}).drop("__year", "__known", "__load")


def line_jobs(spark: SparkSession, sf: str) -> warehouse.Layout:
    """Orders and lines in three loads of increments, run through the jobs."""
    layout = new_layout(snapshots=False)
    for name in ("Customers", "Products", "Warehouses", "Factories"):
        store(ods(spark, sf, name.lower()), layout, name, LOADS[0])
    orders = order_loads(spark, sf, snapshots=False)
    # the lines of all loads are stored at once; the jobs of a date read the load of that date alone
    sinks.replace_partitions(line_loads(spark, sf), f"{layout.ods}.OrderDetails").require_complete()
    for day in LOADS:
        # the last load brings lines of 2000 alone: their orders have come before
        store(orders[day].limit(0) if day == AS_OF else orders[day], layout, "Orders", day)
        warehouse.build_dwd_orderdetails(spark, day, layout)
        warehouse.build_dws_orderdetails(spark, day, layout)
    return layout


def view(spark: SparkSession, sf: str, name: str, snapshots: bool, as_of: str = AS_OF) -> DataFrame:
    """A view over the jobs' tables as a user of a date sees it; the session's own views are left alone."""
    return views.view_of(spark, name, as_of, daily_jobs(spark, sf, snapshots))


@query
def jobs_increments_daily_kpi(spark, sf):
    """A1 and V6 after late and changed orders."""
    return view(spark, sf, "dws_daily_kpi", snapshots=False)


@query
def jobs_snapshots_daily_kpi(spark, sf):
    return view(spark, sf, "dws_daily_kpi", snapshots=True)


@query
def jobs_between_loads_daily_kpi(spark, sf):
    """A1 and V6 as known on the second load, though the third one is stored."""
    return view(spark, sf, "dws_daily_kpi", snapshots=False, as_of=LOADS[1])


@query
def jobs_increments_weekly_trend(spark, sf):
    """W2."""
    return view(spark, sf, "dws_orders_weekly_trend", snapshots=False)


@query
def jobs_increments_customers(spark, sf):
    """A3."""
    layout = daily_jobs(spark, sf, snapshots=False)
    return spark.table(f"{layout.dws}.dws_customer_analytics").filter(F.col("dt") == AS_OF).drop("dt")


@query
def jobs_increments_lines_daily(spark, sf):
    """A4 after late and changed lines, whose orders came in older loads."""
    layout = line_jobs(spark, sf)
    return order_views.one_row_per_date(spark.table(f"{layout.dws}.dws_orderdetails_daily_summary")).drop("dt")


@query
def jobs_increments_products(spark, sf):
    """A5."""
    layout = line_jobs(spark, sf)
    return spark.table(f"{layout.dws}.dws_product_analytics").filter(F.col("dt") == AS_OF).drop("dt")


@query
def jobs_increments_warehouses(spark, sf):
    """A6; the efficiency of a line is that of the load it came in, so its mean is left out."""
    layout = line_jobs(spark, sf)
    return spark.table(f"{layout.dws}.dws_warehouse_analytics").filter(F.col("dt") == AS_OF).drop("dt", "avg_efficiency_score")


def order_states(spark: SparkSession, sf: str) -> warehouse.Layout:
    """Orders in three loads of increments, their daily states replaced load by load."""
    layout = new_layout(snapshots=False)
    for name in ("Customers", "Employees"):
        store(ods(spark, sf, name.lower()), layout, name, LOADS[0])
    for day, rows in order_loads(spark, sf, snapshots=False).items():
        store(rows, layout, "Orders", day)
        warehouse.build_dwd_orders(spark, day, layout)
        states.build_states(spark, day, layout)
    return layout


@query
def jobs_states_monthly(spark, sf):
    """A2 merged from daily states."""
    return states.monthly_summary(spark, AS_OF, order_states(spark, sf))


@query
def jobs_states_customers(spark, sf):
    """A3 merged from daily states."""
    return states.customer_analytics(spark, AS_OF, order_states(spark, sf))


@query
def jobs_states_products(spark, sf):
    """A5 merged from daily states of lines."""
    layout = line_jobs(spark, sf)
    for day in LOADS:
        states.build_states(spark, day, layout, "products")
    return states.product_analytics(spark, AS_OF, layout)


@query
def jobs_states_warehouses(spark, sf):
    """A6 merged from daily states of lines, the exact measures; the efficiency of a line is that of its load."""
    layout = line_jobs(spark, sf)
    for day in LOADS:
        states.build_states(spark, day, layout, "warehouses")
    merged = states.warehouse_analytics(spark, AS_OF, layout)
    return merged.drop("avg_efficiency_score", "unique_orders", "unique_products")


@query
def jobs_increments_status_summary(spark, sf):
    """A7 through its view."""
    return view(spark, sf, "dwd_orders_status_summary", snapshots=False)


@query
def jobs_snapshots_status_summary(spark, sf):
    return view(spark, sf, "dwd_orders_status_summary", snapshots=True)


@query
def jobs_range_status_summary(spark, sf):
    """Three loads cleaned in one pass, each with its own snapshot of the customers."""
    layout = new_layout(snapshots=False)
    for name in ("Customers", "Employees"):
        rows = ods(spark, sf, name.lower())
        for day in LOADS[:2]:  # the third load takes the newest one there is
            store(rows, layout, name, day)
    for day, rows in order_loads(spark, sf, snapshots=False).items():
        store(rows, layout, "Orders", day)
    warehouse.build_dwd_orders_range(spark, LOADS, layout)
    return views.view_of(spark, "dwd_orders_status_summary", AS_OF, layout)


@query
def jobs_report_kpi(spark, sf):
    """R2 saved by the report job."""
    layout = daily_jobs(spark, sf, snapshots=False)
    report_plan.build_reports(spark, AS_OF, layout, "kpi_window")
    return spark.table(f"{layout.dws}.report_kpi_window").filter(F.col("dt") == AS_OF).drop("dt")


@query
def jobs_report_segments(spark, sf):
    """R3 saved by the report job."""
    layout = daily_jobs(spark, sf, snapshots=True)
    report_plan.build_reports(spark, AS_OF, layout, "segments")
    saved = spark.table(f"{layout.dws}.report_segments").filter(F.col("dt") == AS_OF).drop("dt")
    return rounded(saved, "avg_orders_per_customer")


@query
def jobs_report_text(spark, sf):
    """R7 saved by the report job, over line jobs in increments."""
    layout = line_jobs(spark, sf)
    report_plan.build_reports(spark, AS_OF, layout, "text")
    return spark.table(f"{layout.dws}.report_text").filter(F.col("dt") == AS_OF).drop("dt")


@query
def jobs_published_kpi(spark, sf):
    """A view of the catalog, read from another session."""
    layout = daily_jobs(spark, sf, snapshots=False)
    report_plan.publish_views(spark, ["dws_orders_daily_summary"], AS_OF, layout, f"pub_{layout.dws}")
    return spark.table(f"pub_{layout.dws}.dws_daily_kpi")


@query
def jobs_validate_orderdetails(spark, sf):
    """D2 over rows that were written."""
    layout = new_layout(snapshots=True)
    for name in ("Orders", "OrderDetails", "Customers", "Products", "Warehouses", "Factories"):
        store(ods(spark, sf, name.lower()), layout, name, AS_OF)
    warehouse.build_dwd_orderdetails(spark, AS_OF, layout)
    written = spark.table(f"{layout.dwd}.dwd_orderdetails").filter(F.col("dt") == AS_OF)
    return quality.validate_orderdetails(lines_fact(spark, sf, "products"), written)


@query
def jobs_sync_summary(spark, sf):
    """R1 from the copy itself."""
    layout = new_layout(snapshots=True)
    specs = [TableSpec(name, f"{layout.ods}.{name}", mode="full") for name in COPIED]
    summary = sync.sync_all(spark, specs, AS_OF, lambda session, spec: ods(session, sf, spec.source))
    return summary.withColumns(
        {
            "table_name": F.substring_index("table_name", ".", -1),
            "processed_date": F.col("processed_date").cast("timestamp_ntz"),
        }
    )


@query
def jobs_upsert(spark, sf):
    """Two copies with an overlap and a replayed older state, one row per order."""
    layout = new_layout(snapshots=False)
    spec = TableSpec("orders", f"{layout.ods}.Orders", "UpdatedDate", None, strategy="upsert", keys=("OrderID",), lookback_days=3)
    now = ods(spark, sf, "orders").select("OrderID", "Status", "TotalAmount", "UpdatedDate")
    before = now.filter(F.col("UpdatedDate") < "2000-01-01")
    older = now.withColumns({"Status": F.lit("Older"), "UpdatedDate": F.date_sub("UpdatedDate", 1)})
    sync.sync_table(spark, spec, LOADS[0], lambda *_: before)
    sync.sync_table(spark, spec, LOADS[1], lambda *_: now.unionByName(older))
    return upserted(spark, spec.target)


@query
def jobs_upsert_three_deltas(spark, sf):
    """Three closed intervals of the change time, the source growing between and within runs."""
    layout = new_layout(snapshots=False)
    spec = TableSpec("orders", f"{layout.ods}.Orders", "UpdatedDate", None, strategy="upsert", keys=("OrderID",), buckets=16)
    now = ods(spark, sf, "orders").select("OrderID", "Status", "TotalAmount", "UpdatedDate")
    states = [now.filter(F.col("UpdatedDate") < day).withColumn("Status", F.lit("Early")) for day in ("1995-01-01", "1998-06-01")]
    for day, rows in zip(LOADS, [*states, now]):
        sync.sync_table(spark, spec, day, lambda *_: rows)
        sync.sync_table(spark, spec, day, lambda *_: now)  # again, when the source has moved on
    late = now.filter(F.col("UpdatedDate") < "1998-06-01")
    full = TableSpec("orders", spec.target, "UpdatedDate", None, mode="full", strategy="upsert", keys=("OrderID",))
    sync.sync_table(spark, full, LOADS[2], lambda *_: late)
    return upserted(spark, spec.target)


@query
def jobs_schema_changes(spark, sf):
    """A copy whose source gains a column and a wider key and amount between its loads, then lacks the column again."""
    layout = new_layout(snapshots=False)
    spec = TableSpec("orders", f"{layout.ods}.Orders", "UpdatedDate", schema_change="widen")
    now = ods(spark, sf, "orders").select("OrderID", "Status", "TotalAmount", "UpdatedDate")
    narrow = now.withColumns({"OrderID": F.col("OrderID").cast("int"), "TotalAmount": F.col("TotalAmount").cast("decimal(12,2)")}).drop("Status")
    states = [narrow.filter(F.col("UpdatedDate") < "1995-01-01"), now.filter(F.col("UpdatedDate") < "1998-06-01"), narrow]
    for day, rows in zip(LOADS, states):
        sync.sync_table(spark, spec, day, lambda *_: rows)
    return spark.table(spec.target).drop("dt")
