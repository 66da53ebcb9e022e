"""Rules at their limits: just below, on and just above each step, and NULL."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import bands, columns, measures, values
from tallyhouse.operators import summaries

LADDERS = [
    (bands.ORDER_SIZE, {999: "Micro", 1000: "Small", 4999: "Small", 5000: "Medium", 9999: "Medium", 10000: "Large"}),
    (bands.ORDER_PRIORITY, {4999: "Low", 5000: "Medium", 9999: "Medium", 10000: "High"}),
    (bands.QUALITY_LEVEL, {70: "Poor", 71: "Fair", 85: "Fair", 86: "Good"}),
    (bands.PRICE_CATEGORY, {499: "Medium", 500: "High", 999: "High", 1000: "Premium"}),
    (
        bands.CUSTOMER_SEGMENT,
        {4999: "Bronze", 5000: "Silver", 19999: "Silver", 20000: "Gold", 49999: "Gold", 50000: "Platinum"},
    ),
    (
        bands.CUSTOMER_STATUS,
        {7: "Active", 8: "Recent", 30: "Recent", 31: "Inactive", 90: "Inactive", 91: "Dormant"},
    ),
    (bands.PRODUCT_TIER, {9999: "Tier 4", 10000: "Tier 3", 50000: "Tier 2", 99999: "Tier 2", 100000: "Tier 1"}),
    (bands.DEMAND_LEVEL, {99: "Very Low", 100: "Low", 499: "Low", 500: "Medium", 999: "Medium", 1000: "High"}),
    (bands.WAREHOUSE_GRADE, {79: "D", 80: "C", 89: "C", 90: "B", 94: "B", 95: "A"}),
    (bands.PERFORMANCE_GRADE, {79: "Poor", 80: "Fair", 90: "Good", 94: "Good", 95: "Excellent"}),
    (bands.DISCOUNT_LEVEL, {4: "None", 5: "Low", 14: "Low", 15: "Medium", 30: "High"}),
]


@pytest.mark.parametrize("ladder, expected", LADDERS)
def test_ladder(spark, ladder, expected):
    rows = spark.createDataFrame([(Decimal(k),) for k in [*expected, 0]] + [(None,)], "x decimal(20,2)")
    got = {r[0]: r[1] for r in rows.select("x", ladder.of(F.col("x"))).collect()}
    assert {k: got[Decimal(k)] for k in expected} == expected
    assert got[None] == ladder.rest


def test_standardised_passes_unknown_codes_and_null(spark):
    rows = spark.createDataFrame([("已完成",), ("Canceled",), ("OnHold",), (None,)], "s string")
    got = [r[0] for r in rows.select(columns.standardised(F.col("s"), values.ORDER_STATUS)).collect()]
    assert got == ["Delivered", "Cancelled", "OnHold", None]
    same = [r[0] for r in rows.select(columns.standardised(F.col("s"), {})).collect()]
    assert same == ["已完成", "Canceled", "OnHold", None]


def test_defaults_keep_the_column_type_and_refuse_text_for_numbers(spark):
    rows = spark.createDataFrame([(None, None)], "a decimal(10,2), b string")
    filled = columns.with_defaults(rows, {"a": 0, "b": "x", "not_there": "y"})
    assert filled.first() == (Decimal("0.00"), "x") and filled.dtypes == rows.dtypes
    with pytest.raises(TypeError):
        columns.with_defaults(rows, {"a": "zero"})


D = date
DELIVERY = [
    ("Cancelled", D(2020, 1, 5), D(2020, 1, 9), "Cancelled"),
    ("Delivered", D(2020, 1, 9), D(2020, 1, 5), "Completed"),
    ("Shipped", D(2020, 1, 5), D(2020, 1, 5), "OnTime"),
    ("Shipped", D(2020, 1, 6), D(2020, 1, 5), "Late"),
    ("Pending", None, D(2020, 1, 9), "Overdue"),
    ("Pending", None, D(2020, 1, 10), "Pending"),
    ("Pending", None, None, "Pending"),
    ("Shipped", D(2020, 1, 5), None, "Pending"),
    (None, None, D(2020, 1, 1), "Overdue"),
]


def test_delivery_status_first_match_wins(spark):
    rows = spark.createDataFrame(
        DELIVERY, "OrderStatus string, ShippedDate date, RequiredDate date, expected string"
    )
    for row in rows.withColumn("got", columns.delivery_status("2020-01-10")).collect():
        assert row["got"] == row["expected"], row


def test_delay_is_unknown_while_a_date_is_open(spark):
    rows = spark.createDataFrame(
        [(D(2020, 1, 2), D(2020, 1, 1)), (D(2020, 1, 1), D(2020, 1, 1)), (None, D(2020, 1, 1)), (D(2020, 1, 1), None)],
        "ShippedDate date, RequiredDate date",
    )
    assert [r[0] for r in rows.select(columns.is_delayed()).collect()] == [True, False, None, None]


def test_order_quality_points(spark):
    rows = spark.createDataFrame(
        [
            ("Ann", "Street", D(2020, 1, 1), Decimal(1)),
            ("Unknown Customer", "Street", D(2020, 1, 1), Decimal(1)),
            ("Ann", "Address Not Provided", None, Decimal(1)),
            ("Unknown Customer", "Address Not Provided", None, Decimal(0)),
            ("Ann", "Street", D(2020, 1, 1), None),
        ],
        "CustomerName string, ShippingAddress string, RequiredDate date, TotalAmount decimal(20,2)",
    )
    got = [r[0] for r in rows.select(columns.order_quality_score(bands.OrderRules())).collect()]
    assert got == [100, 85, 85, 45, 100]


def test_line_amounts_are_exact(spark):
    rows = spark.createDataFrame(
        [(Decimal("3.33"), Decimal("9.99"), Decimal("12.50"))],
        "Quantity decimal(10,2), UnitPrice decimal(10,2), Discount decimal(5,2)",
    )
    total, discount, net = rows.select(*(c.alias(n) for n, c in columns.line_amounts().items())).first()
    assert total == Decimal("33.2667") and discount == Decimal("4.1583375")
    assert net == total - discount


def test_rates_and_growth_survive_zero(spark):
    rows = spark.createDataFrame([(0, 0), (1, 4), (6, 4), (4, 4), (3, None)], "now bigint, before bigint")
    got = rows.select(measures.rate("now", "before"), measures.growth("now", "before")).collect()
    assert [tuple(r) for r in got] == [
        (None, None),
        (25.0, Decimal("-75.00")),
        (150.0, Decimal("50.00")),
        (100.0, Decimal("0.00")),
        (None, None),
    ]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="OrderStatus"):
        summaries.customer_analytics(spark.range(1), "2020-01-01")
