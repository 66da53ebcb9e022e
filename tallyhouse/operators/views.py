"""Filter, ranking and trend views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import values as v
from tallyhouse.functions.bands import PERFORMANCE_GRADE, Bands
from tallyhouse.operators.snapshots import last_days


# ------------------------------------------------------------ filters
def orders_active(orders: DataFrame) -> DataFrame:
    """V1."""
    status, level = F.col("OrderStatus"), F.col("DataQualityLevel")
    return orders.filter(status.isin(*v.OPEN_ORDER_STATUSES) & level.isin(*v.GOOD_LEVELS))


def orders_delayed(orders: DataFrame) -> DataFrame:
    """Late orders that are still open; an unknown delay is not late."""
    return orders.filter(F.col("IsDelayed") & ~F.col("OrderStatus").isin(*v.CLOSED_ORDER_STATUSES))


def orders_high_value(orders: DataFrame, amount: int = 10000) -> DataFrame:
    """V3."""
    return orders.filter((F.col("OrderPriority") == "High") & (F.col("TotalAmount") >= amount))


def orderdetails_high_value(lines: DataFrame) -> DataFrame:
    """V4."""
    return lines.filter(F.col("IsHighValue") & F.col("DataQualityLevel").isin(*v.GOOD_LEVELS))


def orderdetails_discounted(lines: DataFrame) -> DataFrame:
    """V5."""
    return lines.filter(F.col("IsDiscounted") & (F.col("Discount") > 0))


# ------------------------------------------------------------ indicators
def performance_grade(rate: str, bands: Bands = PERFORMANCE_GRADE) -> Column:
    """M12."""
    return bands.of(F.col(rate)).alias("performance_grade")


def one_row_per_date(
    summary: DataFrame, date: str = "order_date", part_col: str = "dt", as_of: str | None = None
) -> DataFrame:
    """The row of every date from its newest load, not after ``as_of`` if that is given.

    Snapshots repeat each date in every load, and a load of increments writes every date
    it changes anew; a trend over all of them would compare two loads of one date.
    """
    if part_col not in summary.columns:
        return summary
    if as_of is not None:
        summary = summary.filter(F.col(part_col) <= as_of)
    rest = [c for c in summary.columns if c not in (date, part_col)]
    newest = summary.groupBy(date).agg(F.max(F.struct(part_col, *rest)).alias("row"))
    return newest.select(date, "row.*")


def daily_kpi(daily: DataFrame) -> DataFrame:
    """V6."""
    return daily.select(
        "order_date",
        "total_orders",
        "total_amount",
        "avg_order_value",
        "completion_rate",
        "cancellation_rate",
        "delay_rate",
        performance_grade("completion_rate"),
    )


def orderdetails_daily_kpi(daily: DataFrame) -> DataFrame:
    """V9."""
    return daily.select(
        "order_date",
        "total_items",
        "total_amount",
        "avg_item_value",
        "delivery_rate",
        "cancellation_rate",
        "discount_rate",
        "high_value_rate",
        performance_grade("delivery_rate"),
    )


def monthly_business_metrics(monthly: DataFrame) -> DataFrame:
    """V7."""
    percentages = {
        "vip_percentage": "vip_ratio",
        "large_order_percentage": "large_order_ratio",
        "completion_percentage": "completion_rate",
    }
    return monthly.select(
        "year_month",
        "total_orders",
        "total_amount",
        "vip_orders",
        "large_orders",
        *(F.round(rate, 2).alias(name) for name, rate in percentages.items()),
        F.round("avg_processing_days", 1).cast("decimal(9,1)").alias("avg_processing_days"),
    )


def high_value_customers(customers: DataFrame, spent: int = 20000) -> DataFrame:
    """V8, biggest spenders first."""
    valued = F.col("customer_segment").isin("Platinum", "Gold") | (F.col("total_spent") >= spent)
    return (
        customers.filter(valued)
        .select(
            "CustomerID",
            "CustomerName",
            "CustomerType",
            "customer_segment",
            "customer_status",
            "total_spent",
            "total_orders",
            "avg_order_value",
            "completion_rate",
            "days_since_last_order",
            "order_frequency",
        )
        .orderBy(F.desc("total_spent"), "CustomerID")
    )


# ------------------------------------------------------------ rankings
# Every ranking ends in a key: rows with equal measures then have a fixed order, and
# the sort can put them into different tasks.
def product_performance(products: DataFrame) -> DataFrame:
    """O1: products by score."""
    ranked = products.orderBy(F.desc("product_performance_score"), "product_id")
    return ranked.select(
        "product_name",
        "product_tier",
        "total_revenue",
        "total_quantity_sold",
        "demand_level",
        "product_performance_score",
    )


def top_products(products: DataFrame, tiers: tuple[str, ...] = ("Tier 1", "Tier 2")) -> DataFrame:
    """O1: the products of the best tiers by score."""
    best = products.filter(F.col("product_tier").isin(*tiers))
    return best.select(
        "product_id",
        "product_name",
        "product_category",
        "product_tier",
        "demand_level",
        "total_revenue",
        "total_orders",
        "avg_revenue_per_order",
        "delivery_rate",
        "product_performance_score",
    ).orderBy(F.desc("product_performance_score"), "product_id")


def warehouse_performance(warehouses: DataFrame) -> DataFrame:
    """O1: warehouses by efficiency."""
    ranked = warehouses.orderBy(F.desc("avg_efficiency_score"), "warehouse_id")
    return ranked.select(
        "warehouse_name",
        "factory_name",
        "total_items_processed",
        "total_value_handled",
        "delivery_rate",
        "avg_efficiency_score",
        "warehouse_performance_grade",
    )


def warehouse_ranking(warehouses: DataFrame) -> DataFrame:
    """O1: warehouses by delivery rate, then by value."""
    return warehouses.select(
        "warehouse_id",
        "warehouse_name",
        "warehouse_manager",
        "factory_name",
        "warehouse_performance_grade",
        "delivery_rate",
        "total_items_processed",
        "total_value_handled",
        "avg_efficiency_score",
    ).orderBy(F.desc("delivery_rate"), F.desc("total_value_handled"), "warehouse_id")


# ------------------------------------------------------------ trends
def with_previous(df: DataFrame, order_col: str, previous: Mapping[str, str], n: int = 1) -> DataFrame:
    """Columns of the row ``n`` places before, by their new names.

    The window is global, so the input must be small: a row per day or per month.
    """
    by_date = Window.orderBy(order_col)
    return df.withColumns({name: F.lag(col, n).over(by_date) for name, col in previous.items()})


def orders_trend(daily: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Each day with the day before; the last days only, if a date is given.

    The first day shown has no day before it, even if the table has one.
    """
    shown = one_row_per_date(daily, as_of=as_of).select(
        "order_date", "total_orders", "total_amount", "completion_rate", "delay_rate"
    )
    if as_of is not None:
        shown = last_days(shown, as_of, days)
    previous = {"prev_day_orders": "total_orders", "prev_day_amount": "total_amount"}
    return with_previous(shown, "order_date", previous).orderBy(F.desc("order_date"))


def orderdetails_trend(daily: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """W4."""
    shown = one_row_per_date(daily, as_of=as_of).select(
        "order_date", "total_items", "total_amount", "total_quantity", "delivery_rate", "discount_rate"
    )
    if as_of is not None:
        shown = last_days(shown, as_of, days)
    previous = {"prev_day_items": "total_items", "prev_day_amount": "total_amount"}
    return with_previous(shown, "order_date", previous).orderBy(F.desc("order_date"))


def orders_monthly_trend(monthly: DataFrame, as_of: str | None = None) -> DataFrame:
    """Each month with the month before, as far as known on a date, if one is given."""
    shown = one_row_per_date(monthly, "year_month", as_of=as_of).select(
        "year_month",
        "total_orders",
        "total_amount",
        "avg_order_value",
        "vip_ratio",
        "large_order_ratio",
        "completion_rate",
    )
    previous = {"prev_month_orders": "total_orders", "prev_month_amount": "total_amount"}
    return with_previous(shown, "year_month", previous).orderBy(F.desc("year_month"))
