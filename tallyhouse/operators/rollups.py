"""Summary views and load statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions import measures as m
from tallyhouse.functions.bands import SEGMENT_RANK
from tallyhouse.functions.columns import discount_level


def orders_status_summary(orders: DataFrame) -> DataFrame:
    """A7."""
    return orders.groupBy("OrderStatus").agg(
        m.count_rows().alias("order_count"),
        F.sum("TotalAmount").alias("total_amount"),
        F.avg("TotalAmount").alias("avg_amount"),
        m.count_of("IsDelayed", True).alias("delayed_count"),
    )


def product_sales_summary(lines: DataFrame) -> DataFrame:
    """A8."""
    return lines.groupBy("ProductID", "ProductName", "ProductCategory").agg(
        m.count_rows().alias("order_count"),
        F.sum("Quantity").alias("total_quantity"),
        F.sum("NetAmount").alias("total_amount"),
        F.avg("UnitPrice").alias("avg_unit_price"),
        F.avg("Discount").alias("avg_discount"),
    )


def warehouse_efficiency_summary(lines: DataFrame) -> DataFrame:
    """A9."""
    return lines.groupBy("WarehouseID", "WarehouseName", "FactoryName").agg(
        m.count_rows().alias("total_items"),
        m.count_of("OrderDetailStatus", "Delivered").alias("delivered_items"),
        F.avg(F.col("WarehouseEfficiency").cast(t.EFFICIENCY)).cast("double").alias("efficiency_score"),
    )


def segment_order(segment: str = "customer_segment"):
    """O2: the segments in order of value."""
    rank = F.lit(len(SEGMENT_RANK))
    for place, name in reversed(list(enumerate(SEGMENT_RANK))):
        rank = F.when(F.col(segment) == name, F.lit(place)).otherwise(rank)
    return rank


def customer_value_segments(customers: DataFrame) -> DataFrame:
    """A10, in order of value."""
    return (
        customers.groupBy("customer_segment")
        .agg(
            m.count_rows().alias("customer_count"),
            F.sum("total_spent").alias("segment_revenue"),
            F.avg("total_spent").alias("avg_customer_value"),
            F.avg("total_orders").alias("avg_orders_per_customer"),
            F.avg("avg_order_value").alias("avg_order_value"),
            m.count_of("customer_status", "Active").alias("active_customers"),
        )
        .orderBy(segment_order())
    )


def customer_status_analysis(customers: DataFrame) -> DataFrame:
    """A11."""
    return customers.groupBy("customer_status").agg(
        m.count_rows().alias("customer_count"),
        F.sum("total_spent").alias("status_revenue"),
        F.avg("days_since_last_order").alias("avg_days_since_last_order"),
        F.avg("order_frequency").alias("avg_monthly_frequency"),
    )


def product_category_analysis(products: DataFrame) -> DataFrame:
    """A12, by revenue."""
    return (
        products.groupBy("product_category")
        .agg(
            m.count_rows().alias("product_count"),
            F.sum("total_revenue").alias("category_revenue"),
            F.avg("total_revenue").alias("avg_product_revenue"),
            F.avg("delivery_rate").alias("avg_delivery_rate"),
            F.avg("product_performance_score").alias("avg_performance_score"),
        )
        .orderBy(F.desc("category_revenue"), "product_category")
    )


def factory_summary(warehouses: DataFrame) -> DataFrame:
    """A second level on top of the warehouse table, by value."""
    return (
        warehouses.groupBy("factory_name", "factory_location")
        .agg(
            m.count_rows().alias("warehouse_count"),
            F.sum("total_items_processed").alias("total_items"),
            F.sum("total_value_handled").alias("total_value"),
            F.avg("delivery_rate").alias("avg_delivery_rate"),
            F.avg("avg_efficiency_score").alias("avg_efficiency"),
        )
        .orderBy(F.desc("total_value"), "factory_name", "factory_location")
    )


def orders_by_date(orders: DataFrame, date: str = "date", amount: str = "amount") -> DataFrame:
    """Count, sum and mean of an amount per date."""
    return orders.groupBy(F.col(date).alias("date")).agg(
        m.count_rows().alias("order_count"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
    )


def orders_transform_stats(orders: DataFrame) -> DataFrame:
    """Totals and three distributions of a load in one pass.

    One row per (dimension, value); the row ``total`` has the whole load.  Rows are grouped once
    by all three, the few groups then make the four sets.
    """
    dims = {"quality": "DataQualityLevel", "status": "OrderStatus", "priority": "OrderPriority"}
    keys = [F.col(c) for c in dims.values()]
    sets = [[], *([key] for key in keys)]
    days = F.col("ProcessingDays").cast("decimal(14,6)")
    grouped = orders.groupBy(*keys).agg(
        m.count_rows().alias("n"),
        m.count_of("IsDelayed", True).alias("late"),
        F.sum(days).alias("days"),
        F.count(days).alias("closed"),
    )
    mean = F.try_divide(F.sum("days").cast("decimal(28,6)"), F.sum("closed").cast("decimal(10,0)")).cast(t.DAYS)
    stats = grouped.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("set"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("delayed_orders"),
        mean.alias("avg_processing_days"),
    )
    return _by_dimension(stats, dims)


def orderdetails_transform_stats(lines: DataFrame) -> DataFrame:
    """A16, same layout as A15."""
    dims = {"quality": "DataQualityLevel"}
    key = F.col("DataQualityLevel")
    stats = lines.groupingSets([[], [key]], key).agg(
        F.grouping_id().alias("set"),
        m.count_rows().alias("records"),
        m.mean("UnitPrice").alias("avg_unit_price"),
        m.count_of("IsHighValue", True).alias("high_value_items"),
    )
    return _by_dimension(stats, dims)


def _by_dimension(stats: DataFrame, dims: dict[str, str]) -> DataFrame:
    """Name each grouping set; its id has a 0 bit for the one key it groups by."""
    everything = (1 << len(dims)) - 1
    dimension, value = F.lit("total"), F.lit(None).cast("string")
    for place, (name, key) in enumerate(dims.items()):
        mine = F.col("set") == everything - (1 << (len(dims) - 1 - place))
        dimension = F.when(mine, F.lit(name)).otherwise(dimension)
        value = F.when(mine, F.col(key)).otherwise(value)
    named = stats.withColumns({"dimension": dimension, "value": value})
    return named.select("dimension", "value", *(c for c in stats.columns if c not in ("set", *dims.values())))


def rows_per_partition(df: DataFrame, part_col: str = "dt") -> DataFrame:
    """A17, by date."""
    return df.groupBy(part_col).agg(m.count_rows().alias("record_count")).orderBy(part_col)


def unique_count(df: DataFrame, column: str) -> DataFrame:
    """Rows and distinct values of a column."""
    return df.agg(m.count_rows().alias("record_count"), F.count_distinct(column).alias("unique_count"))


def discount_levels(lines: DataFrame, bulk_quantity: int = 100) -> DataFrame:
    """Lines, bulk lines and money per discount level."""
    return lines.groupBy(discount_level(F.col("Discount")).alias("discount_level")).agg(
        m.count_rows().alias("line_count"),
        F.count_if(F.col("Quantity") >= bulk_quantity).alias("bulk_lines"),
        m.total("DiscountAmount").alias("total_discount"),
        m.total("NetAmount").alias("total_amount"),
    )
