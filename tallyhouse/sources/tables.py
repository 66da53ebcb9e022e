"""Reading stored tables and literal rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# ---- Fixed values: columns, key and change column of the copied tables ------
SOURCE_TABLES = {
    "customers": {
        "key": "CustomerID",
        "changed": "UpdatedDate",
        "columns": (
            "CustomerID",
            "CustomerName",
            "ContactPerson",
            "ContactPhone",
            "Email",
            "Address",
            "CustomerType",
            "CreditLimit",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "employees": {
        "key": "EmployeeID",
        "changed": "UpdatedDate",
        "columns": (
            "EmployeeID",
            "EmployeeName",
            "Username",
            "Department",
            "Position",
            "ContactPhone",
            "Email",
            "Status",
            "LastLoginTime",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "products": {
        "key": "ProductID",
        "changed": "UpdatedDate",
        "columns": (
            "ProductID",
            "ProductName",
            "Specification",
            "Category",
            "Description",
            "UnitPrice",
            "Barcode",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "orders": {
        "key": "OrderID",
        "changed": "UpdatedDate",
        "columns": (
            "OrderID",
            "CustomerID",
            "OrderDate",
            "RequiredDate",
            "ShippedDate",
            "Status",
            "PaymentMethod",
            "PaymentStatus",
            "TotalAmount",
            "Discount",
            "ShippingAddress",
            "ShippingMethod",
            "Remarks",
            "CreatedBy",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "orderdetails": {
        "key": "OrderDetailID",
        "changed": "UpdatedDate",
        "columns": (
            "OrderDetailID",
            "OrderID",
            "ProductID",
            "Quantity",
            "UnitPrice",
            "Discount",
            "Amount",
            "WarehouseID",
            "Status",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "inventory": {
        "key": "InventoryID",
        "changed": "UpdatedDate",
        "columns": (
            "InventoryID",
            "ProductID",
            "WarehouseID",
            "Quantity",
            "Unit",
            "ProductionDate",
            "ExpiryDate",
            "BatchNumber",
            "Status",
            "LastCountDate",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "inventorytransactions": {
        "key": "TransactionID",
        "changed": "CreatedDate",
        "columns": (
            "TransactionID",
            "ProductID",
            "WarehouseID",
            "TransactionType",
            "Quantity",
            "UnitPrice",
            "RelatedOrderID",
            "TransactionDate",
            "BatchNumber",
            "Operator",
            "Remarks",
            "CreatedDate",
        ),
    },
    "warehouses": {
        "key": "WarehouseID",
        "changed": "UpdatedDate",
        "columns": (
            "WarehouseID",
            "FactoryID",
            "WarehouseName",
            "Capacity",
            "Manager",
            "ContactPhone",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
    "factories": {
        "key": "FactoryID",
        "changed": "UpdatedDate",
        "columns": (
            "FactoryID",
            "FactoryName",
            "Location",
            "ContactPerson",
            "ContactPhone",
            "ProductionCapacity",
            "CreatedDate",
            "UpdatedDate",
        ),
    },
}


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """S6."""
    return spark.createDataFrame(list(rows), schema)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """S7."""
    return spark.table(name)


def parquet_files(spark: SparkSession, *paths: str) -> DataFrame:
    """S10."""
    return spark.read.parquet(*paths)
