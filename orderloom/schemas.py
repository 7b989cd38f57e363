"""Table contracts: names, types and keys of every curated table.

One ``StructType`` per table is used both for the last cast before a write and
for the catalog definition, so files and tables cannot disagree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types users of the curated tables rely on, and
# the source spelling of the columns that are renamed.
# "key" stands for the integer type of ids.
_SILVER_COLUMNS = {
    "categories": "category_id key, category_name string, description string",
    "order_details": (
        "order_id key, product_id key, unit_price decimal(10,2), quantity int, "
        "discount decimal(5,2), total_price decimal(22,2)"
    ),
    "employees": (
        "employee_id key, employee_name string, title string, city string, country string, "
        "manager_id key"
    ),
    "customers": (
        "customer_id string, company string, contact_name string, contact_title string, "
        "city string, country string"
    ),
    "products": (
        "product_id key, product_name string, quantity_per_unit string, "
        "unit_price decimal(10,2), discontinued int, category_id key"
    ),
    "orders": (
        "order_id key, customer_id string, employee_id key, order_date date, "
        "required_date date, shipped_date date, shipper_id key, freight decimal(10,2), "
        "delivery_status string, ingestion_timestamp timestamp"
    ),
    "shippers": "shipper_id key, shipping_company_name string",
}

SOURCE_NAMES = {
    "categories": {"categoryID": "category_id", "categoryName": "category_name"},
    "order_details": {
        "orderID": "order_id",
        "productID": "product_id",
        "unitPrice": "unit_price",
    },
    "employees": {
        "employeeID": "employee_id",
        "employeeName": "employee_name",
        "reportsTo": "manager_id",
    },
    "customers": {
        "customerID": "customer_id",
        "companyName": "company",
        "contactName": "contact_name",
        "contactTitle": "contact_title",
    },
    "products": {
        "productID": "product_id",
        "productName": "product_name",
        "quantityPerUnit": "quantity_per_unit",
        "unitPrice": "unit_price",
        "categoryID": "category_id",
    },
    "orders": {
        "orderID": "order_id",
        "customerID": "customer_id",
        "employeeID": "employee_id",
        "orderDate": "order_date",
        "requiredDate": "required_date",
        "shippedDate": "shipped_date",
        "shipperID": "shipper_id",
    },
    "shippers": {"shipperID": "shipper_id", "companyName": "shipping_company_name"},
}

_EVENT_COLUMNS = (
    "order_id key, customer_id string, employee_id key, order_date string, "
    "required_date string, shipped_date string, shipper_id key, freight double"
)

TABLES = tuple(_SILVER_COLUMNS)


def silver_schema(table: str, key_type: str = "int") -> T.StructType:
    """Schema of a curated table; ``key_type="bigint"`` for ids beyond 2**31."""
    return _parse_columns(_SILVER_COLUMNS[table], key_type)


def silver_columns(table: str) -> list[str]:
    """Column names of a curated table; needs no session."""
    return [column.split()[0] for column in _SILVER_COLUMNS[table].split(", ")]


def event_schema(key_type: str = "int") -> T.StructType:
    """Schema of an order event as it arrives: dates are still text."""
    return _parse_columns(_EVENT_COLUMNS, key_type)


def _parse_columns(columns: str, key_type: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(", "))
    ddl = ", ".join(f"{name} {key_type if kind == 'key' else kind}" for name, kind in pairs)
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns, order and types of ``schema``."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
