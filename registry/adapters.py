"""Order-business tables derived from the star tables, as SQL both engines run.

The star tables are clean, so NULLs, unknown codes, open dates, zero amounts and
keys without a dimension row are planted by value.  Every source row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# An exact hundredth of a whole number
CENTS = "CAST(CAST({0} AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL({1}))"

ADAPTERS: dict[str, tuple[str, str]] = {
    "ods_customers": (
        "customer",
        """
SELECT c_custkey AS CustomerID,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS CustomerName,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'VIP'
            WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'Regular' END AS CustomerType
FROM {customer}""",
    ),
    "ods_employees": (
        "supplier",
        """
SELECT s_suppkey AS EmployeeID, s_name AS EmployeeName,
       concat('Department-', CAST(s_nationkey AS STRING)) AS Department
FROM {supplier}""",
    ),
    "ods_factories": (
        "nation",
        """
SELECT n_nationkey AS FactoryID, n_name AS FactoryName,
       concat('Region-', CAST(n_regionkey AS STRING)) AS Location
FROM {nation}""",
    ),
    "ods_warehouses": (
        "supplier",
        """
SELECT s_suppkey AS WarehouseID, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS WarehouseName,
       s_nationkey AS FactoryID, concat('Manager-', CAST(s_nationkey AS STRING)) AS Manager
FROM {supplier}""",
    ),
    "ods_products": (
        "part",
        """
SELECT p_partkey AS ProductID,
       CASE WHEN p_size = 7 THEN NULL ELSE p_name END AS ProductName,
       CASE p_type WHEN 'ECONOMY' THEN '电子产品' WHEN 'PROMO' THEN 'clothing' WHEN 'LARGE' THEN '家具'
                   WHEN 'MEDIUM' THEN 'food' WHEN 'SMALL' THEN 'Gadgets' ELSE NULL END AS Category,
       p_brand AS Specification
FROM {part}""",
    ),
    "ods_orders": (
        "orders",
        f"""
SELECT o_orderkey AS OrderID,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS CustomerID,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey % 12 END AS CreatedBy,
       CAST(o_orderdate AS DATE) AS OrderDate, CAST(o_orderdate AS DATE) AS CreatedDate,
       CASE WHEN o_orderkey % 20 = 3 THEN NULL
            ELSE CAST(o_orderdate + INTERVAL '14' DAY AS DATE) END AS RequiredDate,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate + INTERVAL '20' DAY AS DATE)
            ELSE CAST(o_orderdate + INTERVAL '5' DAY AS DATE) END AS ShippedDate,
       CASE WHEN o_orderkey % 13 = 0 THEN 'Canceled' WHEN o_orderkey % 17 = 0 THEN 'OnHold'
            WHEN o_orderstatus = 'F' THEN '已完成' WHEN o_orderstatus = 'O' THEN 'In Transit'
            ELSE 'Processing' END AS Status,
       'Card' AS PaymentMethod,
       CASE WHEN o_orderstatus = 'F' THEN '已支付' WHEN o_orderstatus = 'O' THEN 'Pending Payment'
            ELSE 'Escrow' END AS PaymentStatus,
       CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DECIMAL(20,2))
            ELSE {CENTS.format("CAST(round(o_totalprice * 100) AS BIGINT) % 2500000", "20,2")} END AS TotalAmount,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DECIMAL(20,2)) END AS Discount,
       CASE WHEN o_orderkey % 15 = 0 THEN NULL
            ELSE concat('Addr-', CAST(o_custkey AS STRING)) END AS ShippingAddress,
       CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE)
            ELSE CAST(o_orderdate + INTERVAL '5' DAY AS DATE) END AS UpdatedDate
FROM {{orders}}""",
    ),
    "ods_orderdetails": (
        "lineitem",
        f"""
SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, l_partkey AS ProductID,
       CASE WHEN l_tax > 0.075 THEN NULL ELSE l_suppkey END AS WarehouseID,
       CAST(l_quantity AS DECIMAL(10,2)) AS Quantity,
       {CENTS.format("CAST(round(l_extendedprice * 100) AS BIGINT) % 150000", "10,2")} AS UnitPrice,
       CAST(CAST(round(l_discount * 100) AS INT) AS DECIMAL(5,2)) AS Discount,
       CASE WHEN l_returnflag = 'R' THEN '退货' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '已完成'
            WHEN l_returnflag = 'A' THEN 'delivered' WHEN l_linestatus = 'O' THEN 'Backorder'
            ELSE 'cancelled' END AS Status
FROM {{lineitem}}""",
    ),
}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def business_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the order-business tables, as a view over the given Parquet files."""
    source, text = ADAPTERS[name]
    return spark.sql(text, **{source: base_table(spark, sf_dir, source)})


def adapter_cte(name: str) -> str:
    source, text = ADAPTERS[name]
    return text.format(**{source: source})
