"""Threshold ladders: a value gets the name of the first step it meets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Steps from the strictest to the loosest, and the name for everything else.

    ``upper`` steps are met by values at or below the step, the others by values
    at or above it.  NULL meets no step.
    """

    steps: tuple[tuple[float, str], ...]
    rest: str
    upper: bool = False

    def of(self, value: Column) -> Column:
        arms = F
        for limit, name in self.steps:
            arms = arms.when(value <= limit if self.upper else value >= limit, F.lit(name))
        return arms.otherwise(F.lit(self.rest))


# ---- Fixed values: the thresholds of the business rules -------------------
ORDER_SIZE = Bands(((10000, "Large"), (5000, "Medium"), (1000, "Small")), "Micro")
ORDER_PRIORITY = Bands(((10000, "High"), (5000, "Medium")), "Low")
QUALITY_LEVEL = Bands(((70, "Poor"), (85, "Fair")), "Good", upper=True)
PRICE_CATEGORY = Bands(((1000, "Premium"), (500, "High")), "Medium")
CUSTOMER_SEGMENT = Bands(((50000, "Platinum"), (20000, "Gold"), (5000, "Silver")), "Bronze")
CUSTOMER_STATUS = Bands(((7, "Active"), (30, "Recent"), (90, "Inactive")), "Dormant", upper=True)
PRODUCT_TIER = Bands(((100000, "Tier 1"), (50000, "Tier 2"), (10000, "Tier 3")), "Tier 4")
TIER_POINTS = {"Tier 1": 100, "Tier 2": 80, "Tier 3": 60, "Tier 4": 40}
DEMAND_LEVEL = Bands(((1000, "High"), (500, "Medium"), (100, "Low")), "Very Low")
WAREHOUSE_GRADE = Bands(((95, "A"), (90, "B"), (80, "C")), "D")
PERFORMANCE_GRADE = Bands(((95, "Excellent"), (90, "Good"), (80, "Fair")), "Poor")
DISCOUNT_LEVEL = Bands(((30, "High"), (15, "Medium"), (5, "Low")), "None")
SEGMENT_RANK = ("Platinum", "Gold", "Silver", "Bronze")


@dataclass(frozen=True)
class OrderRules:
    size: Bands = ORDER_SIZE
    priority: Bands = ORDER_PRIORITY
    quality: Bands = QUALITY_LEVEL
    vip_type: str = "VIP"
    # points taken from 100
    unknown_customer: int = 15
    no_address: int = 10
    no_required_date: int = 5
    no_amount: int = 25


@dataclass(frozen=True)
class DetailRules:
    price: Bands = PRICE_CATEGORY
    quality: Bands = QUALITY_LEVEL
    high_value: int = 10000
    unknown_product: int = 15
    unknown_category: int = 10


@dataclass(frozen=True)
class CustomerRules:
    segment: Bands = CUSTOMER_SEGMENT
    status: Bands = CUSTOMER_STATUS
    month_days: int = 30


@dataclass(frozen=True)
class ProductRules:
    tier: Bands = PRODUCT_TIER
    tier_points: dict = field(default_factory=lambda: dict(TIER_POINTS))
    demand: Bands = DEMAND_LEVEL
    # percent weights of delivery, non-cancellation and revenue tier; they add to 100
    weights: tuple[int, int, int] = (40, 30, 30)


@dataclass(frozen=True)
class WarehouseRules:
    grade: Bands = WAREHOUSE_GRADE
