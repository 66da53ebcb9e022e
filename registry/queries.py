"""Every registered query: a whole-table run of one operator over the given files.

The facts are taken as one full snapshot, loaded on ``AS_OF``: each order and line
counts once.  The queries named ``*_30d`` read the 31 dates of the increment window
instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.adapters import base_table, business_table
from tallyhouse.functions import columns, values
from tallyhouse.operators import by_key, dwd, quality, reports, rollups, snapshots, summaries, views
from tallyhouse.operators.joins import DimSpec, widen
from tallyhouse.sinks import tables as sinks
from tallyhouse.sources import tables

AS_OF = "2001-08-01"  # the newest order date of the tables
WINDOW_AS_OF = "2000-10-31"
LOADED_UNTIL = "2000-01-01"  # increments: what the target already holds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


# ------------------------------------------------------------ inputs
def ods(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return business_table(spark, sf, f"ods_{name}")


def orders_fact(spark: SparkSession, sf: str, employees: bool = False) -> DataFrame:
    creators = ods(spark, sf, "employees") if employees else None
    fact = dwd.dwd_orders(ods(spark, sf, "orders"), ods(spark, sf, "customers"), creators, batch_date=AS_OF)
    return fact.drop("etl_created_date")


def lines_fact(spark: SparkSession, sf: str, *dims: str) -> DataFrame:
    """Order lines with the dimensions named; a dimension no reader needs is not joined."""
    names = ("orders", "customers", "products", "warehouses", "factories")
    parts = [ods(spark, sf, n) if n in dims else None for n in names]
    return dwd.dwd_orderdetails(ods(spark, sf, "orderdetails"), *parts, batch_date=AS_OF).drop("etl_created_date")


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.orders_daily_summary(orders_fact(spark, sf))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.orders_monthly_summary(orders_fact(spark, sf))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.customer_analytics(orders_fact(spark, sf), AS_OF)


def lines_daily(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.orderdetails_daily_summary(lines_fact(spark, sf, "orders"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return by_key.product_analytics(ods(spark, sf, "orderdetails"), ods(spark, sf, "products"), batch_date=AS_OF)


def warehouses(spark: SparkSession, sf: str) -> DataFrame:
    return by_key.warehouse_analytics(*(ods(spark, sf, n) for n in ("orderdetails", "warehouses", "factories")), batch_date=AS_OF)


def lines_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return views.orderdetails_daily_kpi(lines_daily(spark, sf))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Means of doubles depend on the order of addition in their last digits."""
    return df.withColumns({c: F.round(c, places) for c in columns})


# ------------------------------------------------------------ cleaned facts
@query
def dwd_orders(spark, sf):
    return orders_fact(spark, sf, employees=True)


@query
def dwd_orderdetails(spark, sf):
    return lines_fact(spark, sf, "orders", "customers", "products", "warehouses", "factories")


@query
def warehouse_efficiency(spark, sf):
    lines = views_of_lines(spark, sf)
    return dwd.warehouse_efficiency(lines).select(
        "OrderID", "LineNumber", "ProductID", "WarehouseID", "WarehouseName", "WarehouseEfficiency"
    )


def views_of_lines(spark, sf):
    return lines_fact(spark, sf, "warehouses")


# ------------------------------------------------------------ aggregate tables
@query
def orders_daily_summary(spark, sf):
    return daily(spark, sf)


@query
def orders_monthly_summary(spark, sf):
    return monthly(spark, sf)


@query
def orders_monthly_summary_30d(spark, sf):
    fact = by_order_date(orders_fact(spark, sf))
    recent = snapshots.window_by_dt(fact, WINDOW_AS_OF, 30)
    return summaries.orders_monthly_summary(recent, WINDOW_AS_OF[:7])


@query
def customer_analytics(spark, sf):
    return customers(spark, sf)


@query
def customer_analytics_30d(spark, sf):
    fact = by_order_date(orders_fact(spark, sf))
    return summaries.customer_analytics(snapshots.window_by_dt(fact, WINDOW_AS_OF, 30), WINDOW_AS_OF)


@query
def orderdetails_daily_summary(spark, sf):
    return lines_daily(spark, sf)


@query
def product_analytics(spark, sf):
    return products(spark, sf)


@query
def product_analytics_30d(spark, sf):
    fact = by_order_date(lines_fact(spark, sf, "orders", "products"))
    return summaries.product_analytics(snapshots.window_by_dt(fact, WINDOW_AS_OF, 30))


@query
def warehouse_analytics(spark, sf):
    return warehouses(spark, sf)


def by_order_date(fact: DataFrame) -> DataFrame:
    """Increment regime: a load holds the orders of its day.  A date, so that ranges reach the scan."""
    return fact.withColumn("dt", F.col("OrderDate"))


# ------------------------------------------------------------ summary views, statistics
@query
def orders_status_summary(spark, sf):
    return rollups.orders_status_summary(orders_fact(spark, sf))


@query
def product_sales_summary(spark, sf):
    return rollups.product_sales_summary(lines_fact(spark, sf, "products"))


@query
def warehouse_efficiency_summary(spark, sf):
    names = ("orderdetails", "warehouses", "factories")
    summary = by_key.warehouse_efficiency_summary(*(ods(spark, sf, n) for n in names), batch_date=AS_OF)
    return rounded(summary, "efficiency_score")


@query
def customer_value_segments(spark, sf):
    return rounded(rollups.customer_value_segments(customers(spark, sf)), "avg_orders_per_customer")


@query
def customer_status_analysis(spark, sf):
    return rounded(rollups.customer_status_analysis(customers(spark, sf)), "avg_days_since_last_order")


@query
def product_category_analysis(spark, sf):
    return rounded(rollups.product_category_analysis(products(spark, sf)), "avg_delivery_rate")


@query
def factory_summary(spark, sf):
    return rounded(rollups.factory_summary(warehouses(spark, sf)), "avg_delivery_rate")


@query
def orders_by_date(spark, sf):
    return rollups.orders_by_date(ods(spark, sf, "orders"), "OrderDate", "TotalAmount")


@query
def orders_transform_stats(spark, sf):
    return rollups.orders_transform_stats(orders_fact(spark, sf))


@query
def orderdetails_transform_stats(spark, sf):
    return rollups.orderdetails_transform_stats(lines_fact(spark, sf, "products"))


@query
def rows_per_partition(spark, sf):
    return rollups.rows_per_partition(by_order_date(ods(spark, sf, "orders")))


@query
def unique_customers(spark, sf):
    return rollups.unique_count(ods(spark, sf, "orders"), "CustomerID")


@query
def discount_levels(spark, sf):
    return rollups.discount_levels(lines_fact(spark, sf))


# ------------------------------------------------------------ filter, indicator, ranking, trend views
ORDER_VIEW = (
    "OrderID",
    "CustomerID",
    "CustomerName",
    "OrderStatus",
    "DeliveryStatus",
    "OrderPriority",
    "TotalAmount",
    "IsDelayed",
    "DataQualityLevel",
)
LINE_VIEW = (
    "OrderID",
    "LineNumber",
    "ProductID",
    "ProductName",
    "ProductCategory",
    "OrderDetailStatus",
    "NetAmount",
    "Discount",
    "DataQualityLevel",
)


@query
def orders_active(spark, sf):
    return views.orders_active(orders_fact(spark, sf)).select(*ORDER_VIEW)


@query
def orders_delayed(spark, sf):
    return views.orders_delayed(orders_fact(spark, sf)).select(*ORDER_VIEW)


@query
def orders_high_value(spark, sf):
    return views.orders_high_value(orders_fact(spark, sf)).select(*ORDER_VIEW)


@query
def orderdetails_high_value(spark, sf):
    return views.orderdetails_high_value(lines_fact(spark, sf, "products")).select(*LINE_VIEW)


@query
def orderdetails_discounted(spark, sf):
    return views.orderdetails_discounted(lines_fact(spark, sf, "products")).select(*LINE_VIEW)


@query
def daily_kpi(spark, sf):
    return views.daily_kpi(daily(spark, sf))


@query
def orderdetails_daily_kpi(spark, sf):
    return lines_kpi(spark, sf)


@query
def monthly_business_metrics(spark, sf):
    return views.monthly_business_metrics(monthly(spark, sf))


@query
def high_value_customers(spark, sf):
    return views.high_value_customers(customers(spark, sf))


@query
def product_performance(spark, sf):
    return views.product_performance(products(spark, sf))


@query
def top_products(spark, sf):
    return views.top_products(products(spark, sf))


@query
def warehouse_performance(spark, sf):
    return views.warehouse_performance(warehouses(spark, sf))


@query
def warehouse_ranking(spark, sf):
    return views.warehouse_ranking(warehouses(spark, sf))


@query
def orders_weekly_trend(spark, sf):
    return views.orders_trend(daily(spark, sf), AS_OF)


@query
def orders_daily_trend(spark, sf):
    return views.orders_trend(daily(spark, sf))


@query
def orders_monthly_trend(spark, sf):
    return views.orders_monthly_trend(monthly(spark, sf))


@query
def orderdetails_weekly_trend(spark, sf):
    return views.orderdetails_trend(lines_daily(spark, sf), AS_OF)


@query
def orderdetails_daily_trend(spark, sf):
    return views.orderdetails_trend(lines_daily(spark, sf))


# ------------------------------------------------------------ increments, snapshots
def loaded_orders(spark, sf):
    """The target of an increment: orders known on a date, in the state of that date."""
    known = ods(spark, sf, "orders").filter(F.col("OrderDate") <= LOADED_UNTIL)
    late = F.col("UpdatedDate") > F.lit(LOADED_UNTIL).cast("date")
    return known.withColumns(
        {
            "Status": F.when(late, F.lit("Processing")).otherwise(F.col("Status")),
            "UpdatedDate": F.when(late, F.col("OrderDate")).otherwise(F.col("UpdatedDate")),
        }
    )


CHANGE_VIEW = ("OrderID", "Status", "TotalAmount", "UpdatedDate")


@query
def incremental_hwm(spark, sf):
    return snapshots.high_water_mark(loaded_orders(spark, sf), "UpdatedDate")


@query
def incremental_delta(spark, sf):
    mark = F.lit(LOADED_UNTIL).cast("date")
    return snapshots.delta(ods(spark, sf, "orders"), "UpdatedDate", mark).select(*CHANGE_VIEW)


@query
def incremental_delta_lookback(spark, sf):
    mark = F.lit(LOADED_UNTIL).cast("date")
    changed = snapshots.delta(ods(spark, sf, "orders"), "UpdatedDate", mark, lookback_days=1)
    return changed.select(*CHANGE_VIEW)


@query
def incremental_upsert(spark, sf):
    target = loaded_orders(spark, sf).select(*CHANGE_VIEW)
    mark = F.lit(LOADED_UNTIL).cast("date")
    changed = snapshots.delta(ods(spark, sf, "orders").select(*CHANGE_VIEW), "UpdatedDate", mark, lookback_days=1)
    return snapshots.upsert(target, changed, ["OrderID"], "UpdatedDate")


def customer_history(spark, sf):
    """Two full snapshots of the customers: before and after the regular ones became VIP."""
    now = ods(spark, sf, "customers")
    later = now.withColumn("CustomerType", F.coalesce("CustomerType", F.lit("VIP")))
    return snapshots.stamp(now, "2001-07-31").unionByName(snapshots.stamp(later, AS_OF))


@query
def dim_snapshot_join(spark, sf):
    dates = ["2001-07-31", AS_OF]
    dt = snapshots.resolve_partition(dates, "2001-08-15", snapshots.STRATEGIES["keep_history"])
    dim = DimSpec(
        customer_history(spark, sf),
        ("CustomerID", "CustomerID"),
        {"CustomerName": "CustomerName", "CustomerType": "CustomerType"},
        dt=dt,
    )
    orders = ods(spark, sf, "orders").select("OrderID", "OrderDate", "CustomerID", "TotalAmount")
    return widen(orders, [dim], ["OrderID", "OrderDate"])


@query
def dim_snapshot_resolved(spark, sf):
    wanted = ods(spark, sf, "orders").select(F.col("OrderDate").cast("string").alias("dt")).distinct()
    return snapshots.resolve_partitions(wanted, ship_dates(spark, sf), snapshots.STRATEGIES["daily"])


def ship_dates(spark, sf):
    shipped = base_table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").cast("string").alias("dt"))
    return shipped.distinct()


@query
def partition_drift(spark, sf):
    wanted = ods(spark, sf, "orders").select(F.col("OrderDate").cast("string").alias("dt")).distinct()
    resolved = snapshots.resolve_partitions(wanted, ship_dates(spark, sf), snapshots.STRATEGIES["daily"])
    return resolved.withColumns(snapshots.drift_columns("target_date", "resolved_date"))


@query
def snapshot_window(spark, sf):
    """Three full snapshots added up would count every order three times; the newest counts it once."""
    orders = ods(spark, sf, "orders").select("OrderID", "OrderDate", "TotalAmount")
    dates = ("2001-07-30", "2001-07-31", AS_OF)
    loads = orders.withColumn("dt", F.explode(F.array(*(F.lit(d) for d in dates))))
    newest = snapshots.latest_snapshot(loads, "2001-08-15")
    return rollups.orders_by_date(newest, "dt", "TotalAmount")


# ------------------------------------------------------------ quality
@query
def validate_orders(spark, sf):
    return quality.validate_orders(orders_fact(spark, sf))


@query
def validate_orderdetails(spark, sf):
    lines = lines_fact(spark, sf, "products")
    return quality.validate_orderdetails(lines, base_table(spark, sf, "lineitem"))


@query
def dq_completeness(spark, sf):
    return quality.check(orders_fact(spark, sf), quality.ORDER_COMPLETENESS)


@query
def dq_completeness_details(spark, sf):
    # the star tables' lines have no OrderDetailID
    rules = [r for r in quality.DETAIL_COMPLETENESS if r.column != "OrderDetailID"]
    return quality.check(ods(spark, sf, "orderdetails"), [*rules, quality.not_null("WarehouseID", 0.05)])


@query
def dq_consistency(spark, sf):
    return quality.check(orders_fact(spark, sf), quality.ORDER_CONSISTENCY)


@query
def dq_status_domain(spark, sf):
    return quality.check(orders_fact(spark, sf), quality.ORDER_STATUS_DOMAIN)


@query
def dq_ranges(spark, sf):
    return quality.check(lines_fact(spark, sf, "products", "warehouses"), quality.DETAIL_RANGES)


@query
def dq_duplicates(spark, sf):
    return quality.duplicates(ods(spark, sf, "orderdetails"), "OrderID", "LineNumber")


@query
def dq_freshness(spark, sf):
    return quality.freshness(ods(spark, sf, "orders"), "CreatedDate", "2001-08-02 12:00:00", 25)


@query
def dq_null_shares(spark, sf):
    return quality.null_shares(ods(spark, sf, "orders"))


@query
def dq_minimum_rows(spark, sf):
    return quality.minimum_rows({name: ods(spark, sf, name) for name in COPIED})


# ------------------------------------------------------------ reports
COPIED = ("customers", "employees", "factories", "warehouses", "products", "orders", "orderdetails")


@query
def sync_summary(spark, sf):
    summary = reports.sync_summary({name: ods(spark, sf, name) for name in COPIED}, AS_OF)
    return summary.withColumn("processed_date", F.col("processed_date").cast("timestamp_ntz"))


@query
def kpi_last_7_days(spark, sf):
    return reports.kpi_window(views.daily_kpi(daily(spark, sf)), AS_OF)


@query
def segment_report(spark, sf):
    return rounded(reports.segment_report(customers(spark, sf)), "avg_orders_per_customer")


@query
def status_report(spark, sf):
    return rounded(reports.status_report(customers(spark, sf)), "avg_days_since_last_order")


@query
def monthly_growth(spark, sf):
    return reports.growth_report(monthly(spark, sf))


@query
def monthly_metrics(spark, sf):
    return reports.metrics_report(monthly(spark, sf))


@query
def kpi_context(spark, sf):
    context = reports.kpi_context(lines_kpi(spark, sf))
    return rounded(context, *(c for c, kind in context.dtypes if kind == "double"))


@query
def grade_distribution(spark, sf):
    return reports.grade_distribution(lines_kpi(spark, sf))


@query
def kpi_report_rows(spark, sf):
    return reports.report_rows(lines_kpi(spark, sf))


@query
def basic_report(spark, sf):
    return reports.basic_report(snapshots.last_days(lines_kpi(spark, sf), AS_OF, 7))


# ------------------------------------------------------------ writing
def scratch(spark: SparkSession, name: str) -> str:
    """A new folder all executors share: where the cluster keeps checkpoints, else in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def partition_replace(spark, sf):
    """All orders written by year, the years from 2000 on replaced by cleaned ones, all read back."""
    path = scratch(spark, "orders_by_year")
    year = F.date_format("OrderDate", "yyyy")
    orders = ods(spark, sf, "orders").select("OrderID", "Status", "TotalAmount", year.alias("dt"))
    clean = orders.withColumn("Status", columns.standardised(F.col("Status"), values.ORDER_STATUS))
    sinks.replace_file_partitions(orders, path, rebalance=True)
    sinks.replace_file_partitions(clean.filter(F.col("dt") >= "2000"), path, rebalance=True)
    stored = tables.parquet_files(spark, path).withColumn("dt", F.col("dt").cast("string"))
    return stored.groupBy("dt", "Status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("TotalAmount").alias("total_amount")
    )
