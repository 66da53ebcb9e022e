"""The views of the warehouse and the tables they stand on."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import rollups, views
from tallyhouse.operators.snapshots import latest_snapshot
from tallyhouse.plans.warehouse import ROW_KEYS, Layout
from tallyhouse.sinks.tables import list_partitions


@dataclass(frozen=True)
class View:
    base: str
    make: Callable[[DataFrame, str], DataFrame]


def plain(make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, str], DataFrame]:
    return lambda df, as_of: make(df)


VIEWS: dict[str, View] = {
    "dwd_orders_active": View("dwd_orders", plain(views.orders_active)),
    "dwd_orders_delayed": View("dwd_orders", plain(views.orders_delayed)),
    "dwd_orders_status_summary": View("dwd_orders", plain(rollups.orders_status_summary)),
    "dwd_orders_high_value": View("dwd_orders", plain(views.orders_high_value)),
    "dwd_orderdetails_high_value": View("dwd_orderdetails", plain(views.orderdetails_high_value)),
    "dwd_orderdetails_discounted": View("dwd_orderdetails", plain(views.orderdetails_discounted)),
    "dwd_orderdetails_product_summary": View("dwd_orderdetails", plain(rollups.product_sales_summary)),
    "dwd_orderdetails_warehouse_performance": View(
        "dwd_orderdetails", plain(rollups.warehouse_efficiency_summary)
    ),
    "dws_orders_weekly_trend": View("dws_orders_daily_summary", views.orders_trend),
    "dws_daily_kpi": View(
        "dws_orders_daily_summary", plain(lambda df: views.daily_kpi(views.one_row_per_date(df)))
    ),
    "dws_orders_monthly_trend": View("dws_orders_monthly_summary", plain(views.orders_monthly_trend)),
    "dws_monthly_business_metrics": View(
        "dws_orders_monthly_summary",
        plain(lambda df: views.monthly_business_metrics(views.one_row_per_date(df, "year_month"))),
    ),
    "dws_customer_value_segments": View("dws_customer_analytics", plain(rollups.customer_value_segments)),
    "dws_customer_status_analysis": View("dws_customer_analytics", plain(rollups.customer_status_analysis)),
    "dws_high_value_customers": View("dws_customer_analytics", plain(views.high_value_customers)),
    "dws_product_performance": View("dws_product_analytics", plain(views.product_performance)),
    "dws_top_performing_products": View("dws_product_analytics", plain(views.top_products)),
    "dws_product_category_analysis": View("dws_product_analytics", plain(rollups.product_category_analysis)),
    "dws_warehouse_performance": View("dws_warehouse_analytics", plain(views.warehouse_performance)),
    "dws_warehouse_performance_ranking": View("dws_warehouse_analytics", plain(views.warehouse_ranking)),
    "dws_factory_summary": View("dws_warehouse_analytics", plain(rollups.factory_summary)),
    "dws_orderdetails_weekly_trend": View("dws_orderdetails_daily_summary", views.orderdetails_trend),
    "dws_orderdetails_daily_kpi": View(
        "dws_orderdetails_daily_summary",
        plain(lambda df: views.orderdetails_daily_kpi(views.one_row_per_date(df))),
    ),
    "orders_summary": View("orders", plain(rollups.orders_by_date)),
}
# Tables that keep one result per run date: a reader sees the newest run.
KEEPS_RUNS = {"dws_customer_analytics", "dws_product_analytics", "dws_warehouse_analytics"}


def register_views(
    spark: SparkSession, available: Iterable[str], as_of: str, layout: Layout
) -> list[str]:
    """Create the views whose base table is available; returns their names.

    Views are session views over DataFrame functions.  They see what was loaded up to the
    date: of a fact the rows that ``Layout.recent`` gives the aggregates, of an aggregate
    that keeps its runs the newest run, of daily and monthly summaries every date once.
    """
    available, made = set(available), []
    for name, view in VIEWS.items():
        if view.base not in available:
            continue
        view_of(spark, name, as_of, layout).createOrReplaceTempView(name)
        made.append(name)
    return made


def view_of(spark: SparkSession, name: str, as_of: str, layout: Layout) -> DataFrame:
    """The rows of a view, without a name in the session."""
    view = VIEWS[name]
    return view.make(rows_up_to(spark, layout, view.base, as_of), as_of)


def rows_up_to(spark: SparkSession, layout: Layout, base: str, as_of: str) -> DataFrame:
    table = f"{layout.database(base)}.{base}"
    if "dt" not in spark.table(table).columns:
        return spark.table(table)
    if base.removeprefix("dwd_") in ROW_KEYS:
        return layout.recent(spark, table, as_of)
    if base in KEEPS_RUNS:
        return latest_snapshot(spark.table(table), as_of, dates=list_partitions(spark, table))
    return spark.table(table).filter(F.col("dt") <= as_of)


def require_views(spark: SparkSession, names: Iterable[str]) -> None:
    """Fail with the names of the views that are not there."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise LookupError(f"missing views: {', '.join(missing)}")
