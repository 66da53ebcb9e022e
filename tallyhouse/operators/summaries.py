"""Aggregate tables over the cleaned facts.

Each takes a fact with one row per order (or order line) and never looks at how it
was loaded: ``window_by_dt`` and ``latest_snapshot`` supply the right rows.  All are
one partial and one final aggregation on the group keys; a very frequent key is
reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse import types as t
from tallyhouse.functions import measures as m
from tallyhouse.functions.bands import CustomerRules, ProductRules, WarehouseRules
from tallyhouse.operators.snapshots import in_month

ORDER_RATES = {
    "completion_rate": "completed_orders",
    "cancellation_rate": "cancelled_orders",
    "delay_rate": "delayed_orders",
}
CUSTOMER_COLUMNS = ("CustomerID", "CustomerName", "CustomerType", "TotalAmount", "OrderDate", "OrderStatus")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """P10."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def order_outcomes() -> dict[str, Column]:
    return {
        "completed_orders": m.count_of("OrderStatus", "Delivered"),
        "cancelled_orders": m.count_of("OrderStatus", "Cancelled"),
        "delayed_orders": m.count_of("IsDelayed", True),
        "high_priority_orders": m.count_of("OrderPriority", "High"),
    }


def order_measures() -> dict[str, Column]:
    """What the daily and the monthly summary have in common."""
    return {
        "total_orders": m.count_rows(),
        "total_amount": m.total("TotalAmount"),
        "avg_order_value": m.mean("TotalAmount"),
        "total_net_amount": m.total("NetAmount"),
        **order_outcomes(),
        "vip_orders": m.count_of("CustomerType", "VIP"),
        "avg_processing_days": m.mean_days("ProcessingDays"),
        "max_order_amount": F.max("TotalAmount").cast(t.AMOUNT),
        "min_order_amount": F.min("TotalAmount").cast(t.AMOUNT),
    }


def quality_counts() -> dict[str, Column]:
    return {
        "good_quality_orders": m.count_of("DataQualityLevel", "Good"),
        "poor_quality_orders": m.count_of("DataQualityLevel", "Poor"),
    }


def named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def by_day(df: DataFrame, measures: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Measures per order date.  The date is grouped as a date and printed afterwards."""
    day = F.col("OrderDate").cast("date").alias("order_date")
    grouped = df.groupBy(*by, day).agg(*named(measures))
    return grouped.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


def orders_daily_summary(orders: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A1.  ``by`` adds group columns such as ``dt`` to run over many loads at once."""
    daily = by_day(orders, {**order_measures(), **quality_counts()}, by)
    return daily.withColumns(
        {
            **m.rates("total_orders", **ORDER_RATES),
            "data_quality_score": m.mean_quality("good_quality_orders", "poor_quality_orders", "total_orders"),
        }
    )


def orders_monthly_summary(orders: DataFrame, month: str | None = None) -> DataFrame:
    """A2 for one month (``yyyy-MM``), or for every month of the fact."""
    if month is not None:
        orders = in_month(orders, month)
    measures = {**order_measures(), **monthly_sizes()}
    grouped = orders.groupBy(F.trunc("OrderDate", "MM").alias("year_month")).agg(*named(measures))
    return monthly_rates(grouped.withColumn("year_month", F.date_format("year_month", "yyyy-MM")))


def monthly_sizes() -> dict[str, Column]:
    return {
        "vip_customer_orders": m.count_of("CustomerType", "VIP"),
        "regular_customer_orders": m.count_of("CustomerType", "Regular"),
        "large_orders": m.count_of("OrderSizeCategory", "Large"),
        "medium_orders": m.count_of("OrderSizeCategory", "Medium"),
        "small_orders": m.count_of("OrderSizeCategory", "Small"),
        "micro_orders": m.count_of("OrderSizeCategory", "Micro"),
    }


def monthly_counts() -> dict[str, Column]:
    """The counts of a month."""
    vip = {"vip_orders": m.count_of("CustomerType", "VIP")}
    return {"total_orders": m.count_rows(), **order_outcomes(), **vip, **monthly_sizes()}


def monthly_rates(grouped: DataFrame) -> DataFrame:
    """What follows from the measures of each month."""
    return grouped.withColumns(m.rates("total_orders", **ORDER_RATES, vip_ratio="vip_orders", large_order_ratio="large_orders"))


def customer_analytics(orders: DataFrame, as_of: str, rules: CustomerRules = CustomerRules()) -> DataFrame:
    """A3: value, activity, segment and status of every customer on a date."""
    require_columns(orders, *CUSTOMER_COLUMNS)
    measures = {
        **customer_counts(),
        "total_spent": m.total("TotalAmount"),
        "avg_order_value": m.mean("TotalAmount"),
        "total_net_spent": m.total("NetAmount"),
        "last_order_date": F.max("OrderDate"),
        "first_order_date": F.min("OrderDate"),
        "avg_processing_days": m.mean_days("ProcessingDays"),
        "max_order_amount": F.max("TotalAmount").cast(t.AMOUNT),
    }
    return customer_profile(orders.groupBy("CustomerID", "CustomerName", "CustomerType").agg(*named(measures)), as_of, rules)


def customer_counts() -> dict[str, Column]:
    return {
        "total_orders": m.count_rows(),
        **order_outcomes(),
        "large_orders": m.count_of("OrderSizeCategory", "Large"),
        "poor_quality_orders": m.count_of("DataQualityLevel", "Poor"),
    }


def customer_profile(grouped: DataFrame, as_of: str, rules: CustomerRules = CustomerRules()) -> DataFrame:
    """What follows from the measures of each customer on a date."""
    lifetime = F.datediff("last_order_date", "first_order_date") + 1
    return grouped.withColumns(
        {
            **m.rates("total_orders", **ORDER_RATES),
            "days_since_last_order": F.datediff(F.lit(as_of).cast("date"), F.col("last_order_date")),
            "customer_lifetime_days": lifetime,
            "customer_segment": rules.segment.of(F.col("total_spent")),
        }
    ).withColumns(
        {
            "order_frequency": m.monthly_frequency("total_orders", "customer_lifetime_days", rules.month_days),
            "customer_status": rules.status.of(F.col("days_since_last_order")),
        }
    )


def line_outcomes(unit: str) -> dict[str, Column]:
    return {
        f"high_value_{unit}": m.count_of("IsHighValue", True),
        f"discounted_{unit}": m.count_of("IsDiscounted", True),
        f"delivered_{unit}": m.count_of("OrderDetailStatus", "Delivered"),
        f"cancelled_{unit}": m.count_of("OrderDetailStatus", "Cancelled"),
    }


def orderdetails_daily_summary(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A4."""
    measures = {
        "total_items": m.count_rows(),
        "total_amount": m.total("NetAmount"),
        "total_quantity": m.total("Quantity"),
        "avg_unit_price": m.mean("UnitPrice"),
        "avg_discount": m.mean("Discount"),
        **line_outcomes("items"),
        "premium_items": m.count_of("PriceCategory", "Premium"),
        "max_unit_price": F.max("UnitPrice").cast(t.AMOUNT),
        "min_unit_price": F.min("UnitPrice").cast(t.AMOUNT),
    }
    return by_day(lines, measures, by).withColumns(
        {
            "avg_item_value": m.per_unit("total_amount", "total_items"),
            **m.rates(
                "total_items",
                discount_rate="discounted_items",
                high_value_rate="high_value_items",
                delivery_rate="delivered_items",
                cancellation_rate="cancelled_items",
            ),
        }
    )


PRODUCT_KEYS = {
    "product_id": "ProductID",
    "product_name": "ProductName",
    "product_category": "ProductCategory",
    "product_specification": "ProductSpecification",
}


def product_analytics(lines: DataFrame, rules: ProductRules = ProductRules()) -> DataFrame:
    """A5: sales, delivery, tier, demand and score of every product."""
    keys = (F.col(c).alias(name) for name, c in PRODUCT_KEYS.items())
    return product_profile(lines.groupBy(*keys).agg(*named(product_measures())), rules)


def product_measures() -> dict[str, Column]:
    return {
        "total_orders": m.count_rows(),
        "total_quantity_sold": m.total("Quantity"),
        "total_revenue": m.total("NetAmount"),
        "avg_unit_price": m.mean("UnitPrice"),
        "avg_discount": m.mean("Discount"),
        **line_outcomes("orders"),
    }


def product_profile(grouped: DataFrame, rules: ProductRules = ProductRules()) -> DataFrame:
    """What follows from the measures of each product."""
    return grouped.withColumns(
        {
            "avg_revenue_per_order": m.per_unit("total_revenue", "total_orders"),
            **m.rates("total_orders", delivery_rate="delivered_orders", cancellation_rate="cancelled_orders"),
            "product_tier": rules.tier.of(F.col("total_revenue")),
            "demand_level": rules.demand.of(F.col("total_quantity_sold")),
        }
    ).withColumn("product_performance_score", m.product_score(rules))


WAREHOUSE_KEYS = {
    "warehouse_id": "WarehouseID",
    "warehouse_name": "WarehouseName",
    "warehouse_manager": "WarehouseManager",
    "factory_name": "FactoryName",
    "factory_location": "FactoryLocation",
}


def warehouse_analytics(
    lines: DataFrame, rules: WarehouseRules = WarehouseRules(), approx_distinct: bool = False
) -> DataFrame:
    """Volume, delivery and grade of every warehouse.

    The two distinct counts are exact unless ``approx_distinct`` trades them for
    sketches.  Exact ones are an aggregate of their own over narrow rows: next to the
    other measures every row would carry all their buffers through the shuffle.  Spark
    moves them by warehouse *and* counted value, so a busy warehouse is spread out.
    """
    efficiency = F.avg(F.col("WarehouseEfficiency").cast(t.EFFICIENCY)).cast(t.AVERAGE)
    measures = {**warehouse_measures(), "avg_efficiency_score": efficiency}
    keys = [F.col(c).alias(name) for name, c in WAREHOUSE_KEYS.items()]
    if approx_distinct:
        sketches = {name: F.approx_count_distinct(c) for name, c in WAREHOUSE_DISTINCT.items()}
        totals = lines.groupBy(*keys).agg(*named({**measures, **sketches}))
    else:
        totals = lines.groupBy(*keys).agg(*named(measures))
        # rows are moved with their key and a hash of its names; should two names of a key have one hash, the query fails
        key, *names = WAREHOUSE_KEYS
        nulls = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in names))  # a hash passes over null values
        group = F.struct(key, F.xxhash64(nulls, *names).alias("names"))
        twice = F.count(F.lit(1)).over(Window.partitionBy("__of")) > 1
        totals = totals.withColumn("__of", group).withColumn("__of", F.when(twice, F.raise_error(F.lit("names of a warehouse share a hash"))).otherwise(F.col("__of")))
        # equal as structs: NULL in a key matches NULL, and readers that use neither
        # count are spared the join, as the groups on the right are unique
        exact = lines.select(*keys, *WAREHOUSE_DISTINCT.values()).groupBy(group.alias("__group")).agg(*named(warehouse_distinct()))
        totals = totals.join(exact, F.col("__of") == F.col("__group"), "left").drop("__group", "__of")
    return warehouse_profile(totals, rules)


WAREHOUSE_DISTINCT = {"unique_orders": "OrderID", "unique_products": "ProductID"}


def warehouse_measures() -> dict[str, Column]:
    """The sums of a warehouse's lines."""
    return {
        "total_items_processed": m.count_rows(),
        "total_quantity_handled": m.total("Quantity"),
        "total_value_handled": m.total("NetAmount"),
        "avg_item_price": m.mean("UnitPrice"),
        "delivered_items": m.count_of("OrderDetailStatus", "Delivered"),
    }


def warehouse_distinct() -> dict[str, Column]:
    return {name: F.count_distinct(c) for name, c in WAREHOUSE_DISTINCT.items()}


def warehouse_profile(totals: DataFrame, rules: WarehouseRules = WarehouseRules()) -> DataFrame:
    """What follows from the measures of each warehouse."""
    return totals.withColumns(
        {
            "delivery_rate": m.rate("delivered_items", "total_items_processed"),
            "avg_value_per_item": m.per_unit("total_value_handled", "total_items_processed"),
        }
    ).withColumn("warehouse_performance_grade", rules.grade.of(F.col("delivery_rate")))
