"""Column rules of the cleaned order and order-line facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions import values as v
from tallyhouse.functions.bands import DISCOUNT_LEVEL, Bands, DetailRules, OrderRules


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default in those of the named columns that ``df`` has.

    A default keeps the column's own type; a text default on a column of another
    type is refused here instead of failing inside the job.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for name, default in defaults.items():
        if name not in fields:
            continue
        kind = fields[name]
        if isinstance(default, str) and kind.typeName() not in ("string", "void"):
            raise TypeError(f"text default for column {name} of type {kind.simpleString()}")
        filled[name] = F.coalesce(F.col(name), F.lit(default).cast(kind))
    return df.withColumns(filled)


def standardised(raw: Column, mapping: Mapping[str, str]) -> Column:
    """Standard name of a raw code; a code without one passes through unchanged.

    The mapping becomes one literal, so a rule built on the result stays small however
    often the optimizer repeats it.
    """
    if not mapping:
        return raw
    names = F.create_map(*(F.lit(text) for pair in mapping.items() for text in pair))
    return F.coalesce(F.try_element_at(names, raw), raw)


def days_between(start: str, end: str) -> Column:
    """C4: whole days from ``start`` to ``end``."""
    return F.datediff(F.col(end), F.col(start))


def is_delayed(shipped: str = "ShippedDate", required: str = "RequiredDate") -> Column:
    """Shipped after the required date; NULL while either date is open."""
    return F.col(shipped) > F.col(required)


def delivery_status(batch_date: str | Column) -> Column:
    """The first state that applies, a closed order before any date comparison."""
    shipped, required, status = (F.col(c) for c in ("ShippedDate", "RequiredDate", "OrderStatus"))
    states = [
        (status == "Cancelled", "Cancelled"),
        (status == "Delivered", "Completed"),
        (shipped <= required, "OnTime"),
        (shipped > required, "Late"),
        (shipped.isNull() & (required < F.lit(batch_date).cast("date")), "Overdue"),
    ]
    return F.coalesce(*(F.when(applies, F.lit(name)) for applies, name in states), F.lit("Pending"))


def calendar_parts(date: str = "OrderDate", prefix: str = "Order") -> dict[str, Column]:
    """Year, month, day, weekday (1 = Sunday) and quarter of a date."""
    parts = {
        "Year": F.year,
        "Month": F.month,
        "Day": F.dayofmonth,
        "DayOfWeek": F.dayofweek,
        "Quarter": F.quarter,
    }
    return {prefix + name: part(F.col(date)) for name, part in parts.items()}


def net_amount() -> Column:
    """An order's discount is an amount of money."""
    return (F.col("TotalAmount") - F.col("Discount")).cast(t.ORDER_AMOUNT)


def order_priority(rules: OrderRules) -> Column:
    """VIP customers are always served first."""
    by_amount = rules.priority.of(F.col("TotalAmount"))
    return F.when(F.col("CustomerType") == rules.vip_type, F.lit("High")).otherwise(by_amount)


def score(*penalties: tuple[Column, int]) -> Column:
    """100 less the points of every condition that is true."""
    out = F.lit(100)
    for condition, points in penalties:
        out = out - F.when(condition, F.lit(points)).otherwise(F.lit(0))
    return out


def order_quality_score(rules: OrderRules) -> Column:
    """C13.  A NULL amount costs nothing here; the completeness check reports it."""
    return score(
        (F.col("CustomerName") == v.UNKNOWN_CUSTOMER, rules.unknown_customer),
        (F.col("ShippingAddress") == v.NO_ADDRESS, rules.no_address),
        (F.col("RequiredDate").isNull(), rules.no_required_date),
        (F.col("TotalAmount") <= 0, rules.no_amount),
    )


def detail_quality_score(rules: DetailRules) -> Column:
    """C15."""
    return score(
        (F.col("ProductName") == v.UNKNOWN_PRODUCT, rules.unknown_product),
        (F.col("ProductCategory") == v.UNKNOWN_CATEGORY, rules.unknown_category),
    )


def line_amounts() -> dict[str, Column]:
    """C11: a line's discount is a percentage.  All three values are exact decimals."""
    quantity, price = (F.col(c).cast("decimal(10,2)") for c in ("Quantity", "UnitPrice"))
    percent = F.col("Discount").cast("decimal(5,2)")
    total = (quantity * price).cast(t.LINE_TOTAL)
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    return {
        "LineTotal": total,
        "DiscountAmount": (total * percent * hundredth).cast(t.LINE_AMOUNT),
        # not the total less the discount: a pushed-down filter on the net amount
        # then works out the total once
        "NetAmount": (total * (100 - percent) * hundredth).cast(t.LINE_AMOUNT),
    }


def flag(condition: Column) -> Column:
    """A condition as a flag that is false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def audit_columns(batch_date: str | Column) -> dict[str, Column]:
    """Load time and batch identifier (``yyyyMMdd``)."""
    return {
        "etl_created_date": F.current_timestamp(),
        "etl_batch_id": F.replace(F.lit(batch_date), F.lit("-"), F.lit("")),
    }


def discount_level(percent: Column, bands: Bands = DISCOUNT_LEVEL) -> Column:
    """Named level of a percentage discount."""
    return bands.of(percent)
