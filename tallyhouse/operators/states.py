"""Mergeable states of the summaries: one row per day and group, merged for any span of days.

A measure is kept as parts that add up: counts, sums, least and greatest values, and sketches for distinct counts. A mean is a
sum and a count. So a day that changes is worked out anew alone, and a window reads states in place of facts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions import measures as m
from tallyhouse.operators import summaries as s

DAY = "state_day"
#: Accuracy of the sketches: two to this many cells, a relative error of about 0.8 %.
SKETCH = 14


@dataclass(frozen=True)
class Measure:
    """Parts of a measure by name, each made from rows; how a part is merged; and the value of the merged parts."""

    parts: Mapping[str, Column]
    merged: Mapping[str, Column]
    value: Column


def _one(name: str, part: Column, merge, kind: str | None = None) -> Measure:
    value = F.col(name) if kind is None else F.col(name).cast(kind)
    return Measure({name: part}, {name: merge(name)}, value)


def added(name: str, count: Column) -> Measure:
    return _one(name, count, F.sum)


def total(name: str, column: str) -> Measure:
    return _one(name, F.sum(column), F.sum, t.AMOUNT)


def greatest(name: str, column: str, kind: str | None = None) -> Measure:
    return _one(name, F.max(column), F.max, kind)


def least(name: str, column: str, kind: str | None = None) -> Measure:
    return _one(name, F.min(column), F.min, kind)


def mean(name: str, column: Column, kind: str = t.AVERAGE) -> Measure:
    of, n = f"{name}__sum", f"{name}__count"
    value = F.try_divide(F.col(of).cast("decimal(28,8)"), F.col(n).cast("decimal(10,0)")).cast(kind)
    return Measure({of: F.sum(column), n: F.count(column)}, {of: F.sum(of), n: F.sum(n)}, value)


def distinct(name: str, column: str) -> Measure:
    sketch = f"{name}__sketch"
    return Measure({sketch: F.hll_sketch_agg(column, SKETCH)}, {sketch: F.hll_union_agg(sketch, False)}, F.hll_sketch_estimate(sketch))


def _counts(of: Mapping[str, Column]) -> dict[str, Measure]:
    return {name: added(name, column) for name, column in of.items()}


def _days_mean(name: str, column: str) -> Measure:
    return mean(name, F.col(column).cast("decimal(14,6)"), t.DAYS)


def monthly_measures() -> dict[str, Measure]:
    sums = {"total_amount": "TotalAmount", "total_net_amount": "NetAmount"}
    return {
        **_counts(s.monthly_counts()),
        **{n: total(n, c) for n, c in sums.items()},
        "avg_order_value": mean("avg_order_value", F.col("TotalAmount")),
        "avg_processing_days": _days_mean("avg_processing_days", "ProcessingDays"),
        "max_order_amount": greatest("max_order_amount", "TotalAmount", t.AMOUNT),
        "min_order_amount": least("min_order_amount", "TotalAmount", t.AMOUNT),
    }


def customer_measures() -> dict[str, Measure]:
    return {
        **_counts(s.customer_counts()),
        "total_spent": total("total_spent", "TotalAmount"),
        "total_net_spent": total("total_net_spent", "NetAmount"),
        "avg_order_value": mean("avg_order_value", F.col("TotalAmount")),
        "last_order_date": greatest("last_order_date", "OrderDate"),
        "first_order_date": least("first_order_date", "OrderDate"),
        "avg_processing_days": _days_mean("avg_processing_days", "ProcessingDays"),
        "max_order_amount": greatest("max_order_amount", "TotalAmount", t.AMOUNT),
    }


def product_measures() -> dict[str, Measure]:
    return {
        **_counts({"total_orders": m.count_rows(), **s.line_outcomes("orders")}),
        "total_quantity_sold": total("total_quantity_sold", "Quantity"),
        "total_revenue": total("total_revenue", "NetAmount"),
        "avg_unit_price": mean("avg_unit_price", F.col("UnitPrice")),
        "avg_discount": mean("avg_discount", F.col("Discount")),
    }


def warehouse_measures() -> dict[str, Measure]:
    """Distinct counts are sketches here."""
    return {
        **_counts({"total_items_processed": m.count_rows(), "delivered_items": m.count_of("OrderDetailStatus", "Delivered")}),
        "total_quantity_handled": total("total_quantity_handled", "Quantity"),
        "total_value_handled": total("total_value_handled", "NetAmount"),
        "avg_item_price": mean("avg_item_price", F.col("UnitPrice")),
        "avg_efficiency_score": mean("avg_efficiency_score", F.col("WarehouseEfficiency").cast(t.EFFICIENCY)),
        "unique_orders": distinct("unique_orders", "OrderID"),
        "unique_products": distinct("unique_products", "ProductID"),
    }


@dataclass(frozen=True)
class Kind:
    """A summary by its fact, its group columns (output name to fact column) and its measures."""

    fact: str
    keys: Mapping[str, str]
    measures: Mapping[str, Measure]


def kinds() -> dict[str, Kind]:
    customers = {c: c for c in ("CustomerID", "CustomerName", "CustomerType")}
    return {
        "monthly": Kind("dwd_orders", {}, monthly_measures()),
        "customers": Kind("dwd_orders", customers, customer_measures()),
        "products": Kind("dwd_orderdetails", s.PRODUCT_KEYS, product_measures()),
        "warehouses": Kind("dwd_orderdetails", s.WAREHOUSE_KEYS, warehouse_measures()),
    }


def states(rows: DataFrame, kind: Kind) -> DataFrame:
    """A row per order date and group: the group columns and the parts of all measures."""
    day = F.date_format("OrderDate", "yyyy-MM-dd").alias(DAY)
    parts = {n: c for x in kind.measures.values() for n, c in x.parts.items()}
    return rows.groupBy(day, *(F.col(c).alias(n) for n, c in kind.keys.items())).agg(*s.named(parts))


def merged(of: DataFrame, kind: Kind, *by: Column) -> DataFrame:
    """The measures of groups over all days of some states; ``by`` are further group columns made from the day."""
    parts = {n: c for x in kind.measures.values() for n, c in x.merged.items()}
    grouped = of.groupBy(*by, *kind.keys).agg(*s.named(parts))
    kept = [c for c in grouped.columns if c not in parts]
    return grouped.select(*kept, *(x.value.alias(n) for n, x in kind.measures.items()))
