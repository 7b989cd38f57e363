"""Cleaning of the seven source tables.

Each plan is one projection, one distinct where the table calls for it, and the
null fill, in that order: copies are recognised on clean text but before missing
keys are filled. Columns that follow from others are added after the distinct,
so that they do not travel through its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import functions as fn
from orderloom.operators import rows
from orderloom.schemas import conform, silver_schema

c = F.col


def order_details(raw: DataFrame, key_type: str = "int") -> DataFrame:
    lines = rows.rename_source_columns(raw, "order_details").select(
        fn.to_int(c("order_id"), key_type).alias("order_id"),
        fn.to_int(c("product_id"), key_type).alias("product_id"),
        fn.to_decimal(c("unit_price"), 10, 2).alias("unit_price"),
        fn.to_int(c("quantity")).alias("quantity"),
        fn.to_decimal(c("discount"), 5, 2).alias("discount"),
    )
    priced = rows.distinct_rows(lines).withColumn(
        "total_price", fn.line_total(c("unit_price"), c("quantity"))
    )
    filled = rows.fill_missing(
        priced, {"order_id": rows.MISSING_ID, "product_id": rows.MISSING_ID}
    )
    return conform(filled, silver_schema("order_details", key_type))


def categories(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """Typed and trimmed only: copies and missing keys stay."""
    named = rows.rename_source_columns(raw, "categories")
    return conform(
        named.select(
            fn.to_int(c("category_id"), key_type).alias("category_id"),
            F.trim(c("category_name")).alias("category_name"),
            F.trim(c("description")).alias("description"),
        ),
        silver_schema("categories", key_type),
    )


def employees(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """Names and places are kept as they come, outer spaces included."""
    people = rows.rename_source_columns(raw, "employees").select(
        fn.to_int(c("employee_id"), key_type).alias("employee_id"),
        *(fn.to_text(c(name)).alias(name) for name in ("employee_name", "title", "city", "country")),
        fn.to_int(c("manager_id"), key_type).alias("manager_id"),
    )
    filled = rows.fill_missing(
        rows.distinct_rows(people),
        {"employee_id": rows.MISSING_ID, "manager_id": rows.MISSING_ID},
    )
    return conform(filled, silver_schema("employees", key_type))


def customers(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """``key_type`` is accepted for uniformity: customer ids are text."""
    names = ("company", "contact_name", "city")
    as_given = ("customer_id", "contact_title", "country")
    typed = rows.rename_source_columns(raw, "customers").select(
        *(fn.to_text(c(name)).alias(name) for name in as_given),
        *(fn.clean_name(fn.to_text(c(name))).alias(name) for name in names),
    )
    filled = rows.fill_missing(rows.distinct_rows(typed), {"customer_id": rows.MISSING_CODE})
    return conform(filled, silver_schema("customers", key_type))


def products(raw: DataFrame, key_type: str = "int") -> DataFrame:
    goods = rows.rename_source_columns(raw, "products").select(
        fn.to_int(c("product_id"), key_type).alias("product_id"),
        fn.clean_name(fn.to_text(c("product_name"))).alias("product_name"),
        fn.pack_size(fn.to_text(c("quantity_per_unit"))).alias("quantity_per_unit"),
        fn.to_decimal(c("unit_price"), 10, 2).alias("unit_price"),
        fn.to_int(c("discontinued")).alias("discontinued"),
        fn.to_int(c("category_id"), key_type).alias("category_id"),
    )
    filled = rows.fill_missing(rows.distinct_rows(goods), {"product_id": rows.MISSING_ID})
    return conform(filled, silver_schema("products", key_type))


def shippers(raw: DataFrame, key_type: str = "int") -> DataFrame:
    carriers = rows.rename_source_columns(raw, "shippers").select(
        fn.to_int(c("shipper_id"), key_type).alias("shipper_id"),
        fn.to_text(c("shipping_company_name")).alias("shipping_company_name"),
    )
    filled = rows.fill_missing(rows.distinct_rows(carriers), {"shipper_id": rows.MISSING_ID})
    return conform(filled, silver_schema("shippers", key_type))


def orders(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """Only the order id is filled; the other ids may stay NULL."""
    headers = rows.rename_source_columns(raw, "orders").select(
        fn.to_int(c("order_id"), key_type).alias("order_id"),
        fn.to_text(c("customer_id")).alias("customer_id"),
        fn.to_int(c("employee_id"), key_type).alias("employee_id"),
        *(
            fn.to_iso_date(c(name)).alias(name)
            for name in ("order_date", "required_date", "shipped_date")
        ),
        fn.to_int(c("shipper_id"), key_type).alias("shipper_id"),
        fn.to_decimal(c("freight"), 10, 2).alias("freight"),
    )
    classified = rows.distinct_rows(headers).withColumns(
        {
            "delivery_status": fn.delivery_status(c("shipped_date"), c("required_date")),
            "ingestion_timestamp": F.current_timestamp(),
        }
    )
    filled = rows.fill_missing(classified, {"order_id": rows.MISSING_ID})
    return conform(filled, silver_schema("orders", key_type))


SILVER_PLANS: dict[str, Callable[..., DataFrame]] = {
    "categories": categories,
    "order_details": order_details,
    "employees": employees,
    "customers": customers,
    "products": products,
    "orders": orders,
    "shippers": shippers,
}
