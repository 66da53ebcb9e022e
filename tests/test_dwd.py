"""The cleaned facts over the full column lists of the source tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.operators import dwd
from tallyhouse.sources.tables import SOURCE_TABLES

TYPES = {
    **{c: "bigint" for c in "CustomerID EmployeeID ProductID OrderID OrderDetailID WarehouseID FactoryID CreatedBy".split()},
    **{c: "date" for c in "OrderDate RequiredDate ShippedDate".split()},
    **{c: "timestamp" for c in "CreatedDate UpdatedDate LastLoginTime".split()},
    **{c: "decimal(20,2)" for c in "TotalAmount CreditLimit Capacity ProductionCapacity Amount".split()},
    **{c: "decimal(10,2)" for c in "Quantity UnitPrice".split()},
}
DISCOUNT = {"orders": "decimal(20,2)", "orderdetails": "decimal(5,2)"}


def rows(spark, table, *values):
    columns = SOURCE_TABLES[table]["columns"]
    kinds = {**TYPES, "Discount": DISCOUNT.get(table)}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(v.get(c) for c in columns) for v in values], schema)


@pytest.fixture(scope="module")
def sources(spark):
    day, noon = date(2024, 5, 1), datetime(2024, 5, 1, 12)
    order = {"OrderDate": day, "CreatedDate": noon, "Status": "已完成", "TotalAmount": Decimal(6000), "PaymentStatus": "已支付"}
    line = {"Quantity": Decimal(3), "UnitPrice": Decimal(500), "Discount": Decimal(10), "Status": "已完成"}
    return {
        "orders": rows(
            spark,
            "orders",
            {**order, "OrderID": 1, "CustomerID": 1, "CreatedBy": 1, "RequiredDate": day, "ShippedDate": date(2024, 5, 3)},
            {**order, "OrderID": 2, "CustomerID": None, "Status": "Odd", "TotalAmount": None},
        ),
        "customers": rows(spark, "customers", {"CustomerID": 1, "CustomerName": "Ann", "CustomerType": "VIP"}),
        "employees": rows(spark, "employees", {"EmployeeID": 1, "EmployeeName": "Bob", "Department": "Sales"}),
        "products": rows(spark, "products", {"ProductID": 1, "ProductName": "Pen", "Category": "文具"}),
        "warehouses": rows(spark, "warehouses", {"WarehouseID": 1, "WarehouseName": "North", "FactoryID": 1}),
        "factories": rows(spark, "factories", {"FactoryID": 1, "FactoryName": "F", "Location": "X"}),
        "orderdetails": rows(
            spark,
            "orderdetails",
            {**line, "OrderDetailID": 1, "OrderID": 1, "ProductID": 1, "WarehouseID": 1},
            {**line, "OrderDetailID": 2, "OrderID": 9, "ProductID": 9, "WarehouseID": 9, "Discount": None},
        ),
    }


def test_orders(spark, sources):
    fact = dwd.dwd_orders(sources["orders"], sources["customers"], sources["employees"], batch_date="2024-05-02")
    expected = list(SOURCE_TABLES["orders"]["columns"]) + (
        "CustomerName CustomerType CreatedByName CreatedByDepartment OrderStatus LeadTimeDays ProcessingDays IsDelayed "
        "DeliveryStatus OrderYear OrderMonth OrderDay OrderDayOfWeek OrderQuarter NetAmount OrderSizeCategory "
        "OrderPriority DataQualityScore DataQualityLevel etl_created_date etl_batch_id"
    ).split()
    assert sorted(fact.columns) == sorted(expected)
    known, unknown = fact.orderBy("OrderID").collect()
    assert (known.OrderStatus, known.PaymentStatus, known.CustomerName, known.CreatedByName) == ("Delivered", "Paid", "Ann", "Bob")
    assert (known.Discount, known.NetAmount, known.Remarks) == (Decimal("0.00"), Decimal("6000.00"), "")
    assert (known.LeadTimeDays, known.ProcessingDays, known.IsDelayed, known.DeliveryStatus) == (0, 2, True, "Completed")
    assert (known.OrderSizeCategory, known.OrderPriority, known.DataQualityScore) == ("Medium", "High", 90)
    assert (known.OrderYear, known.OrderDayOfWeek, known.OrderQuarter, known.etl_batch_id) == (2024, 4, 2, "20240502")
    assert (unknown.OrderStatus, unknown.CustomerName, unknown.CustomerType) == ("Odd", "Unknown Customer", "Regular")
    assert (unknown.OrderSizeCategory, unknown.OrderPriority, unknown.IsDelayed) == ("Micro", "Low", None)
    assert (unknown.DataQualityScore, unknown.DataQualityLevel, unknown.DeliveryStatus) == (70, "Poor", "Pending")


def test_orderdetails(spark, sources):
    dims = [sources[n] for n in ("orders", "customers", "products", "warehouses", "factories")]
    fact = dwd.dwd_orderdetails(sources["orderdetails"], *dims, batch_date="2024-05-02")
    expected = list(SOURCE_TABLES["orderdetails"]["columns"]) + (
        "CustomerID CustomerName CustomerType ProductName ProductCategory ProductSpecification WarehouseName "
        "WarehouseManager FactoryName FactoryLocation OrderDate OrderStatus PaymentMethod PaymentStatus "
        "OrderDetailStatus LineTotal DiscountAmount NetAmount PriceCategory IsHighValue IsDiscounted "
        "WarehouseEfficiency DataQualityScore DataQualityLevel etl_created_date etl_batch_id"
    ).split()
    assert sorted(fact.columns) == sorted(expected)
    known, unknown = fact.orderBy("OrderDetailID").collect()
    assert (known.LineTotal, known.DiscountAmount, known.NetAmount) == (1500, 150, 1350)
    assert (known.ProductCategory, known.OrderDetailStatus, known.OrderStatus) == ("Stationery", "Delivered", "已完成")
    assert (known.PriceCategory, known.IsHighValue, known.IsDiscounted, known.DataQualityScore) == ("High", False, True, 100)
    assert (known.WarehouseName, known.FactoryName, known.WarehouseEfficiency) == ("North", "F", 100.0)
    # an unknown discount leaves the net amount unknown; unknown is neither high nor discounted
    assert (unknown.NetAmount, unknown.IsHighValue, unknown.IsDiscounted) == (None, False, False)
    assert (unknown.ProductName, unknown.ProductCategory, unknown.WarehouseName) == (
        "Unknown Product", "Unknown Category", "Unknown Warehouse",
    )
    assert (unknown.CustomerName, unknown.FactoryName, unknown.DataQualityScore, unknown.DataQualityLevel) == (None, None, 75, "Fair")


def test_a_mapping_of_the_unknown_category_applies_to_it(spark, sources):
    fact = dwd.dwd_orderdetails(
        sources["orderdetails"], None, None, sources["products"], None, None,
        batch_date="2024-05-02", categories={"Unknown Category": "None"},
    )
    got = {r.OrderDetailID: (r.ProductCategory, r.DataQualityScore) for r in fact.collect()}
    assert got == {1: ("文具", 100), 2: ("None", 85)}


def test_own_rules_and_mappings(spark, sources):
    from tallyhouse.functions.bands import Bands, OrderRules

    rules = OrderRules(size=Bands(((1, "Some"),), "None"), vip_type="none", no_address=0)
    fact = dwd.dwd_orders(
        sources["orders"], sources["customers"], None, batch_date="2024-05-02", rules=rules, order_statuses={}
    )
    known = fact.filter("OrderID = 1").first()
    assert (known.OrderStatus, known.OrderSizeCategory, known.OrderPriority) == ("已完成", "Some", "Medium")
    assert known.DataQualityScore == 100 and "CreatedByName" not in fact.columns
