"""Line summaries by dimension key (A5, A6, A9): lines are summed by a narrow key, dimensions meet the sums.

Equal to the same summary over the widened fact of one load, as a key has one set of names. Each line is read without its
names, and one row per key, not per line, meets the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import types as t
from tallyhouse.functions import columns as c
from tallyhouse.functions import measures as m
from tallyhouse.functions import values as v
from tallyhouse.functions.bands import ProductRules, WarehouseRules
from tallyhouse.operators import summaries as s
from tallyhouse.operators.dwd import DETAIL_DEFAULTS, FACTORY, PRODUCT, WAREHOUSE, dwd_orderdetails, efficiency_of
from tallyhouse.operators.joins import DimSpec, through, widen


def plain_lines(details: DataFrame, batch_date: str) -> DataFrame:
    """Cleaned lines without the columns of any dimension."""
    return dwd_orderdetails(details, None, None, None, None, None, batch_date=batch_date)


def product_analytics(
    details: DataFrame,
    products: DataFrame,
    *,
    batch_date: str,
    rules: ProductRules = ProductRules(),
    categories: Mapping[str, str] = v.PRODUCT_CATEGORY,
) -> DataFrame:
    """A5 from raw lines and products."""
    summed = plain_lines(details, batch_date).groupBy("ProductID").agg(*s.named(s.product_measures()))
    standard = products.withColumn("Category", c.standardised(F.col("Category"), categories))
    wide = widen(summed, [DimSpec(standard, ("ProductID", "ProductID"), PRODUCT)], ["ProductID"])
    unknown = {"ProductName": DETAIL_DEFAULTS["ProductName"], "ProductCategory": categories.get(v.UNKNOWN_CATEGORY, v.UNKNOWN_CATEGORY)}
    return s.product_profile(c.with_defaults(wide, unknown).withColumnsRenamed({own: name for name, own in s.PRODUCT_KEYS.items()}), rules)


def _named(summed: DataFrame, warehouses: DataFrame, factories: DataFrame, lines: str, delivered: str) -> DataFrame:
    """Sums by WarehouseID with names and the efficiency of the name, whose lines are added up from the sums."""
    factory = DimSpec(factories, ("FactoryID", "FactoryID"), FACTORY)
    wide = widen(summed, through(DimSpec(warehouses, ("WarehouseID", "WarehouseID"), WAREHOUSE), factory), ["WarehouseID"])
    clean = c.with_defaults(wide.drop("FactoryID"), {"WarehouseName": DETAIL_DEFAULTS["WarehouseName"]})
    by_name = clean.groupBy("WarehouseName").agg(F.sum(lines).alias("lines"), F.sum(delivered).alias("delivered"))
    return clean.join(efficiency_of(by_name), "WarehouseName", "left")


def warehouse_analytics(
    details: DataFrame, warehouses: DataFrame, factories: DataFrame, *, batch_date: str, rules: WarehouseRules = WarehouseRules()
) -> DataFrame:
    """A6 from raw lines, warehouses and factories: two readings of the lines, one for the sums, one for the exact distinct
    counts."""
    lines = plain_lines(details, batch_date)
    summed = lines.groupBy("WarehouseID").agg(*s.named(s.warehouse_measures()))
    exact = lines.groupBy(F.struct("WarehouseID").alias("__group")).agg(*s.named(s.warehouse_distinct()))
    summed = summed.join(exact, F.struct("WarehouseID") == F.col("__group"), "left").drop("__group")
    named = _named(summed, warehouses, factories, "total_items_processed", "delivered_items")
    score = F.col("WarehouseEfficiency").cast(t.EFFICIENCY).cast(t.AVERAGE)
    named = named.withColumn("avg_efficiency_score", score).drop("WarehouseEfficiency")
    return s.warehouse_profile(named.withColumnsRenamed({own: name for name, own in s.WAREHOUSE_KEYS.items()}), rules)


def warehouse_efficiency_summary(details: DataFrame, warehouses: DataFrame, factories: DataFrame, *, batch_date: str) -> DataFrame:
    """A9 from raw lines, warehouses and factories: one reading of the lines."""
    counts = {"total_items": m.count_rows(), "delivered_items": m.count_of("OrderDetailStatus", "Delivered")}
    summed = plain_lines(details, batch_date).groupBy("WarehouseID").agg(*s.named(counts))
    named = _named(summed, warehouses, factories, "total_items", "delivered_items")
    score = F.col("WarehouseEfficiency").cast(t.EFFICIENCY).cast("double").alias("efficiency_score")
    return named.select("WarehouseID", "WarehouseName", "FactoryName", *counts, score)
