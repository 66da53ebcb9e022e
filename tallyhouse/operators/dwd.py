"""Cleaned and widened facts: orders and order lines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions import columns as c
from tallyhouse.functions import values as v
from tallyhouse.functions.bands import DetailRules, OrderRules
from tallyhouse.functions.measures import count_of, count_rows
from tallyhouse.operators.joins import (
    DimSpec,
    HotKeys,
    fits_broadcast,
    hot_share,
    shuffle_partitions,
    split_left_join,
    through,
    widen,
)

# Dimension columns, by their names in the dimension, and their names in the facts
CUSTOMER = {"CustomerName": "CustomerName", "CustomerType": "CustomerType"}
EMPLOYEE = {"EmployeeName": "CreatedByName", "Department": "CreatedByDepartment"}
PRODUCT = {
    "ProductName": "ProductName",
    "Category": "ProductCategory",
    "Specification": "ProductSpecification",
}
WAREHOUSE = {"WarehouseName": "WarehouseName", "Manager": "WarehouseManager", "FactoryID": "FactoryID"}
FACTORY = {"FactoryName": "FactoryName", "Location": "FactoryLocation"}
ORDER = {
    "CustomerID": "CustomerID",
    "OrderDate": "OrderDate",
    "Status": "OrderStatus",
    "PaymentMethod": "PaymentMethod",
    "PaymentStatus": "PaymentStatus",
}
ORDER_DEFAULTS = {
    "CustomerName": v.UNKNOWN_CUSTOMER,
    "CustomerType": v.DEFAULT_CUSTOMER_TYPE,
    "ShippingAddress": v.NO_ADDRESS,
    "Remarks": "",
    "Discount": 0,
    "CreatedByName": v.UNKNOWN_EMPLOYEE,
    "CreatedByDepartment": v.UNKNOWN_DEPARTMENT,
}
DETAIL_DEFAULTS = {
    "ProductName": v.UNKNOWN_PRODUCT,
    "WarehouseName": v.UNKNOWN_WAREHOUSE,
}
# Columns of a line that tell the rows of a hot key apart
SPREAD = ("OrderID", "ProductID", "Quantity", "UnitPrice")


def dwd_orders(
    orders: DataFrame,
    customers: DataFrame,
    employees: DataFrame | None,
    *,
    batch_date: str | Column,
    order_statuses: Mapping[str, str] = v.ORDER_STATUS,
    payment_statuses: Mapping[str, str] = v.PAYMENT_STATUS,
    rules: OrderRules = OrderRules(),
    customers_dt: str | None = None,
    employees_dt: str | None = None,
    check: bool = False,
) -> DataFrame:
    """Orders with customer and creator, standard statuses, delivery and quality columns.

    Without ``employees`` the creator is left out, for readers that do not use it.
    ``batch_date`` may be a column, for rows of several loads.
    ``check`` fails if a dimension holds a key twice.
    """
    dims = [DimSpec(customers, ("CustomerID", "CustomerID"), CUSTOMER, customers_dt, check=check)]
    if employees is not None:
        dims.append(DimSpec(employees, ("CreatedBy", "EmployeeID"), EMPLOYEE, employees_dt, check=check))
    wide = widen(orders, dims, spread_by=["OrderID", "OrderDate"])
    clean = with_standard_amounts(c.with_defaults(wide, ORDER_DEFAULTS)).withColumns(
        {
            "OrderStatus": c.standardised(F.col("Status"), order_statuses),
            "PaymentStatus": c.standardised(F.col("PaymentStatus"), payment_statuses),
        }
    )
    derived = clean.withColumns(
        {
            "LeadTimeDays": c.days_between("OrderDate", "RequiredDate"),
            "ProcessingDays": c.days_between("CreatedDate", "ShippedDate"),
            "IsDelayed": c.is_delayed(),
            "DeliveryStatus": c.delivery_status(batch_date),
            **c.calendar_parts(),
            "NetAmount": c.net_amount(),
            "OrderSizeCategory": rules.size.of(F.col("TotalAmount")),
            "OrderPriority": c.order_priority(rules),
            "DataQualityScore": c.order_quality_score(rules),
        }
    )
    return derived.withColumns(
        {
            "DataQualityLevel": rules.quality.of(F.col("DataQualityScore")),
            **c.audit_columns(batch_date),
        }
    )


def with_standard_amounts(orders: DataFrame) -> DataFrame:
    """Order money as decimals with two places."""
    money = {name: F.col(name).cast(t.ORDER_AMOUNT) for name in ("TotalAmount", "Discount")}
    return orders.withColumns(money)


def dwd_orderdetails(
    details: DataFrame,
    orders: DataFrame | None,
    customers: DataFrame | None,
    products: DataFrame | None,
    warehouses: DataFrame | None,
    factories: DataFrame | None,
    *,
    batch_date: str,
    detail_statuses: Mapping[str, str] = v.DETAIL_STATUS,
    categories: Mapping[str, str] = v.PRODUCT_CATEGORY,
    rules: DetailRules = DetailRules(),
    snapshots: Mapping[str, str | None] | None = None,
    check: bool = False,
) -> DataFrame:
    """Order lines with order, customer, product, warehouse and factory columns.

    A dimension given as None is not joined and its columns are missing, for readers
    that do not use them.  ``snapshots`` gives the partition date to read of the
    dimensions that have one, by argument name.  ``check`` fails if a dimension holds a
    key twice.
    """
    dt = dict(snapshots or {})

    def dim(name: str, df: DataFrame | None, key: str, columns: Mapping[str, str]) -> DimSpec | None:
        return None if df is None else DimSpec(df, (key, key), columns, dt.get(name), check=check)

    dims = []
    if orders is not None:
        customer = dim("customers", customers, "CustomerID", CUSTOMER)
        dims += through(dim("orders", orders, "OrderID", ORDER), customer)
    if products is not None:
        # categories are standardised on the products, not once per line
        standard = products.withColumn("Category", c.standardised(F.col("Category"), categories))
        dims.append(dim("products", standard, "ProductID", PRODUCT))
    if warehouses is not None:
        factory = dim("factories", factories, "FactoryID", FACTORY)
        dims += through(dim("warehouses", warehouses, "WarehouseID", WAREHOUSE), factory)
    wide = widen(details, narrow_first(dims), SPREAD).select(*columns_of(details, dims)).drop("FactoryID")
    unknown = {"ProductCategory": categories.get(v.UNKNOWN_CATEGORY, v.UNKNOWN_CATEGORY)}
    clean = c.with_defaults(wide, {**DETAIL_DEFAULTS, **unknown}).withColumns(
        {"OrderDetailStatus": c.standardised(F.col("Status"), detail_statuses), **c.line_amounts()}
    )
    derived = clean.withColumns(
        {
            "PriceCategory": rules.price.of(F.col("UnitPrice")),
            "IsHighValue": c.flag(F.col("NetAmount") >= rules.high_value),
            "IsDiscounted": c.flag(F.col("Discount") > 0),
        }
    )
    if products is not None:
        derived = derived.withColumn("DataQualityScore", c.detail_quality_score(rules)).withColumn(
            "DataQualityLevel", rules.quality.of(F.col("DataQualityScore"))
        )
    if warehouses is not None:
        by_name = lines_by_name(details, warehouses, dt.get("warehouses"), detail_statuses)
        # a row per warehouse name: never more than the warehouses, plus the unknown one
        derived = with_efficiency(derived, by_name, small=fits_broadcast(warehouses))
    return derived.withColumns(c.audit_columns(batch_date))


def narrow_first(dims: Iterable[DimSpec]) -> list[DimSpec]:
    """Dimensions in the order in which they are joined: lines that are moved for one carry along what they got before.

    So those too large to be broadcast come first, among them those of few columns.
    """
    return sorted(dims, key=lambda d: (0, len(d.columns)) if not fits_broadcast(d.right(d.on[0])) else (1, 0))


def columns_of(fact: DataFrame, dims: Iterable[DimSpec]) -> list[str]:
    """The columns of a fact that meets dimensions in this order, whatever the order in which they are joined."""
    columns = fact.columns
    for dim in dims:
        columns = [dim.on[0], *(c for c in columns if c != dim.on[0]), *dim.columns.values()]
    return columns


def lines_by_name(
    details: DataFrame,
    warehouses: DataFrame,
    dt: str | None = None,
    statuses: Mapping[str, str] = v.DETAIL_STATUS,
) -> DataFrame:
    """Lines and delivered lines by warehouse name, from the raw lines.

    Counted by warehouse key before the names are looked up, so neither a busy
    warehouse nor the lines without one end up in a single task.
    """
    counted = (
        details.select("WarehouseID", c.standardised(F.col("Status"), statuses).alias("state"))
        .groupBy("WarehouseID")
        .agg(count_rows().alias("lines"), count_of("state", "Delivered").alias("delivered"))
    )
    dim = DimSpec(warehouses, ("WarehouseID", "WarehouseID"), {"WarehouseName": "WarehouseName"}, dt)
    named = counted.join(dim.right("WarehouseID"), "WarehouseID", "left")
    return named.groupBy(F.coalesce("WarehouseName", F.lit(v.UNKNOWN_WAREHOUSE)).alias("WarehouseName")).agg(
        F.sum("lines").alias("lines"), F.sum("delivered").alias("delivered")
    )


def efficiency_of(by_name: DataFrame) -> DataFrame:
    return by_name.select(
        "WarehouseName", (F.try_divide("delivered", "lines") * 100).alias("WarehouseEfficiency")
    )


def with_efficiency(lines: DataFrame, by_name: DataFrame, *, small: bool) -> DataFrame:
    """Share of delivered lines of the same warehouse name, in percent.

    ``small`` says that the size of the names has been checked against the limit of a broadcast.
    """
    efficiency = efficiency_of(by_name)
    if small:
        return lines.join(F.broadcast(efficiency), "WarehouseName", "left")
    # the counts at hand say which names are hot: a bounded number of them
    partitions = shuffle_partitions(lines)
    total = by_name.agg(F.sum("lines")).first()[0] or 1
    frequent = by_name.filter(F.col("lines") >= hot_share(partitions) * total)
    counts = {row["WarehouseName"]: row["lines"] for row in frequent.collect()}
    return split_left_join(lines, efficiency, "WarehouseName", SPREAD, HotKeys.among(counts, total, partitions))


def warehouse_efficiency(lines: DataFrame) -> DataFrame:
    """W1 over a cleaned fact: every line with the efficiency of its warehouse name.

    Equal to a window over the whole warehouse.  The names are few or many, so Spark
    chooses the join by the size it finds; should it move the lines, those of a busy name, such as
    the unknown one, go to many tasks.
    """
    lines = lines.drop("WarehouseEfficiency")
    by_name = lines.groupBy("WarehouseName").agg(
        count_rows().alias("lines"), count_of("OrderDetailStatus", "Delivered").alias("delivered")
    )
    return with_efficiency(lines, by_name, small=False)
