"""Data-quality checks (D1 - D8): every rule of a table is counted in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import measures as m
from tallyhouse.functions import values as v


@dataclass(frozen=True)
class Rule:
    """A condition that rows must not meet, and the share of rows that still may."""

    rule: str
    column: str
    fails: Callable[[], Column]
    tolerance: float = 0.0


def not_null(column: str, tolerance: float = 0.0) -> Rule:
    return Rule("not_null", column, lambda: F.col(column).isNull(), tolerance)


def in_range(column: str, low: object = None, high: object = None, tolerance: float = 0.0) -> Rule:
    """Values outside [low, high]; NULL is the business of ``not_null``."""

    def fails() -> Column:
        too_low = F.lit(False) if low is None else F.col(column) < F.lit(low)
        return too_low if high is None else too_low | (F.col(column) > F.lit(high))

    return Rule("in_range", column, fails, tolerance)


def one_of(column: str, allowed: Sequence[str], tolerance: float = 0.0) -> Rule:
    return Rule("one_of", column, lambda: ~F.col(column).isin(*allowed), tolerance)


def length_between(column: str, low: int, high: int, tolerance: float = 0.0) -> Rule:
    return Rule("length", column, lambda: ~F.length(column).between(low, high), tolerance)


def not_before(later: str, earlier: str, tolerance: float = 0.0) -> Rule:
    return Rule("not_before", later, lambda: F.col(later) < F.col(earlier), tolerance)


def at_most_days(later: str, earlier: str, days: int, tolerance: float = 0.0) -> Rule:
    return Rule("at_most_days", later, lambda: F.datediff(F.col(later), F.col(earlier)) > days, tolerance)


# ---- Fixed values: the declared rules of orders and order lines -------------
ORDER_COMPLETENESS = [
    not_null(c, 0.01) for c in ("OrderID", "CustomerID", "OrderDate", "OrderStatus", "TotalAmount")
]
ORDER_CONSISTENCY = [
    in_range("TotalAmount", 0, 1000000),
    not_before("RequiredDate", "OrderDate"),
    at_most_days("RequiredDate", "OrderDate", 365),
]
ORDER_STATUS_DOMAIN = [one_of("OrderStatus", v.VALID_ORDER_STATUSES)]
DETAIL_RANGES = [
    in_range("Quantity", Decimal("0.01"), 10000),
    in_range("UnitPrice", Decimal("0.01"), 1000000),
    in_range("Discount", 0, 100),
    length_between("ProductName", 1, 100),
    length_between("ProductSpecification", 0, 500),
    length_between("WarehouseName", 1, 100),
]
DETAIL_COMPLETENESS = [not_null(c) for c in ("OrderDetailID", "OrderID", "ProductID", "Quantity", "UnitPrice")]


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, column, failures, total, ratio, passed), one row per rule."""
    counts = [F.count_if(r.fails()).alias(f"f{i}") for i, r in enumerate(rules)]
    counted = df.agg(m.count_rows().alias("total"), *counts)
    rows = F.array(
        *(
            F.struct(
                F.lit(r.rule).alias("rule"),
                F.lit(r.column).alias("column"),
                F.col(f"f{i}").alias("failures"),
                F.lit(float(r.tolerance)).alias("tolerance"),
            )
            for i, r in enumerate(rules)
        )
    )
    ratio = F.coalesce(F.try_divide("failures", "total"), F.lit(0.0))
    return counted.select("total", F.inline(rows)).select(
        "rule",
        "column",
        "failures",
        "total",
        ratio.alias("ratio"),
        (ratio <= F.col("tolerance")).alias("passed"),
    )


def validate_orders(orders: DataFrame, max_poor: float = 0.1, max_delayed: float = 0.2) -> DataFrame:
    """Shares of poor rows and of late orders; (check, value, threshold, passed)."""
    counted = orders.agg(
        m.count_rows().alias("total"),
        m.count_of("DataQualityLevel", "Poor").alias("poor"),
        m.count_of("IsDelayed", True).alias("delayed"),
    )
    limits = {"poor_quality_ratio": (_share("poor"), max_poor), "delayed_ratio": (_share("delayed"), max_delayed)}
    return _within(counted, limits)


def validate_orderdetails(lines: DataFrame, written: DataFrame, max_poor: float = 0.1) -> DataFrame:
    """Rows written against rows transformed, and the share of poor rows."""
    counted = lines.agg(m.count_rows().alias("total"), m.count_of("DataQualityLevel", "Poor").alias("poor"))
    stored = written.agg(m.count_rows().alias("n")).scalar()
    difference = F.abs(F.col("total") - stored).cast("double")
    limits = {"record_count_difference": (difference, 0.0), "poor_quality_ratio": (_share("poor"), max_poor)}
    return _within(counted, limits)


def _share(part: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col("total")), F.lit(0.0))


def _within(counted: DataFrame, limits: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """One row per value with the largest one allowed."""
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("check"), value.alias("value"), F.lit(float(most)).alias("threshold"))
            for name, (value, most) in limits.items()
        )
    )
    return counted.select(F.inline(rows)).withColumn("passed", F.col("value") <= F.col("threshold"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key, in the layout of ``check``."""
    per_key = df.groupBy(*keys).agg(m.count_rows().alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    ratio = F.coalesce(F.try_divide("failures", "total"), F.lit(0.0))
    return counted.select(
        F.lit("unique").alias("rule"),
        F.lit(",".join(keys)).alias("column"),
        "failures",
        "total",
        ratio.alias("ratio"),
        (F.col("failures") == 0).alias("passed"),
    )


def freshness(df: DataFrame, column: str, as_of: str, max_hours: int = 24) -> DataFrame:
    """Age of the newest row on a date or time given, in whole hours."""
    newest = F.max(F.col(column).cast("timestamp")).alias("newest")
    age = F.timestamp_diff("HOUR", F.col("newest"), F.lit(as_of).cast("timestamp"))
    return df.agg(newest).select(
        F.lit(column).alias("column"),
        F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"),
        age.alias("age_hours"),
        F.lit(max_hours).cast("bigint").alias("max_hours"),
        F.coalesce(age <= max_hours, F.lit(False)).alias("passed"),
    )


def null_shares(df: DataFrame, max_share: float = 0.5) -> DataFrame:
    """NULL share of every column, all in one pass."""
    return check(df, [not_null(c, max_share) for c in df.columns])


def minimum_rows(tables: Mapping[str, DataFrame], least: int = 1) -> DataFrame:
    """(table_name, record_count, minimum, passed)."""
    rows = [
        df.agg(m.count_rows().alias("record_count")).select(
            F.lit(name).alias("table_name"),
            "record_count",
            F.lit(least).cast("bigint").alias("minimum"),
            (F.col("record_count") >= least).alias("passed"),
        )
        for name, df in tables.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
