"""Aggregates and derived measures shared by the summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions.bands import ProductRules


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_of(column: str, value: object) -> Column:
    """How many rows hold ``value``; rows where the column is NULL do not count."""
    return F.count_if(F.col(column) == F.lit(value))


def total(column: str) -> Column:
    return F.sum(column).cast(t.AMOUNT)


def mean(column: str, kind: str = t.AVERAGE) -> Column:
    return F.avg(column).cast(kind)


def mean_days(column: str) -> Column:
    """Mean of a whole number of days, in decimal arithmetic."""
    return F.avg(F.col(column).cast("decimal(14,6)")).cast(t.DAYS)


def rate(part: str, whole: str) -> Column:
    """M1: share in percent."""
    return (F.try_divide(F.col(part), F.col(whole)) * 100).cast(t.RATE)


def rates(whole: str, **parts: str) -> dict[str, Column]:
    return {name: rate(part, whole) for name, part in parts.items()}


def mean_quality(good: str, poor: str, whole: str) -> Column:
    """M2: four points for a good row, two for a middling one, none for a poor one."""
    middling = F.col(whole) - F.col(good) - F.col(poor)
    return F.try_divide(F.col(good) * 4 + middling * 2, F.col(whole)).cast(t.RATE)


def per_unit(amount: str, count: str) -> Column:
    """M7."""
    return F.try_divide(F.col(amount), F.col(count)).cast(t.AVERAGE)


def monthly_frequency(count: str, days: str, month_days: int) -> Column:
    """M4: orders per month of the customer's lifetime."""
    orders = (F.col(count) * month_days).cast("decimal(20,0)")
    return F.try_divide(orders, F.col(days)).cast(t.FREQUENCY)


def product_score(rules: ProductRules) -> Column:
    """Weighted delivery rate, non-cancellation rate and revenue tier.

    Worked out from the counts so that it is rounded only once:
    (w1 * delivered + w2 * (orders - cancelled)) / orders + w3 / 100 * tier points.
    """
    on_delivery, on_cancel, on_tier = rules.weights
    orders = F.col("total_orders")
    kept = orders - F.col("cancelled_orders")
    earned = (F.col("delivered_orders") * on_delivery + kept * on_cancel).cast("decimal(20,0)")
    points = F.lit(None).cast("decimal(6,2)")
    for tier, worth in rules.tier_points.items():
        share = F.lit(f"{on_tier * worth / 100:.2f}").cast("decimal(6,2)")
        points = F.when(F.col("product_tier") == tier, share).otherwise(points)
    return (F.try_divide(earned, orders) + points).cast(t.AVERAGE)


def active_rate(active: str, count: str) -> Column:
    """Percent with two decimals."""
    share = F.try_divide((F.col(active) * 100).cast("decimal(24,0)"), F.col(count))
    return F.round(share, 2).cast(t.AVERAGE)


def growth(now: str, before: str) -> Column:
    """Percent change with two decimals; NULL without a positive value to compare to."""
    change = ((F.col(now) - F.col(before)) * 100).cast("decimal(34,2)")
    ratio = F.round(F.try_divide(change, F.col(before)), 2).cast(t.AVERAGE)
    return F.when(F.col(before) > 0, ratio)
