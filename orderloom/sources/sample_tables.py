"""The retail tables, derived from the generic star-schema parquet files.

``retail_tables`` gives them typed and clean, as the curated layer would;
``raw_tables`` gives them as a source system might hand them over: source
spelling, numbers and dates as text, padding, broken characters, copies and
missing keys. Both are plain projections and joins that Spark runs in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import functions as fn
from orderloom.functions.text import REPLACEMENT_CHAR

c = F.col

# One employee looks after fifteen neighbouring customers, which spreads the
# customers over the suppliers that stand in for employees.
CUSTOMERS_PER_EMPLOYEE = 15
DAYS_TO_DELIVER = 60

# Declared, so that planning a query reads no file.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

Read = Callable[[str], DataFrame]


def driver_table(spark: SparkSession, sf_dir: str) -> Read:
    """Reader of the given tables by name."""
    return lambda name: spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def retail_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = driver_table(spark, sf_dir)
    return {
        "order_details": _order_details(read),
        "orders": _orders(read),
        "customers": _customers(read),
        "products": _products(read),
        "employees": _employees(read),
        "shippers": _shippers(read),
        "categories": _categories(read),
    }


def _order_details(read: Read) -> DataFrame:
    return read("lineitem").select(
        c("l_orderkey").alias("order_id"),
        c("l_partkey").alias("product_id"),
        c("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        c("l_quantity").cast("int").alias("quantity"),
        c("l_discount").cast("decimal(5,2)").alias("discount"),
    )


def _orders(read: Read) -> DataFrame:
    last_shipment = (
        read("lineitem")
        .groupBy(c("l_orderkey").alias("order_id"))
        .agg(F.max(F.to_date("l_shipdate")).alias("shipped_date"))
    )
    order_date = F.to_date("o_orderdate")
    headers = read("orders").select(
        c("o_orderkey").alias("order_id"),
        c("o_custkey").cast("string").alias("customer_id"),
        F.expr(f"o_custkey div {CUSTOMERS_PER_EMPLOYEE}").alias("employee_id"),
        order_date.alias("order_date"),
        F.date_add(order_date, DAYS_TO_DELIVER).alias("required_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("shipper_id"),
        c("o_totalprice").cast("decimal(10,2)").alias("freight"),
    )
    return headers.join(last_shipment, "order_id", "left").withColumn(
        "delivery_status", fn.delivery_status(c("shipped_date"), c("required_date"))
    )


def _customers(read: Read) -> DataFrame:
    joined = read("customer").join(
        read("nation").select("n_nationkey", "n_name"), c("c_nationkey") == c("n_nationkey"), "left"
    )
    return joined.select(
        c("c_custkey").cast("string").alias("customer_id"),
        c("c_name").alias("company"),
        c("c_mktsegment").alias("contact_name"),
        F.lit("BUYER").alias("contact_title"),
        c("c_nationkey").cast("string").alias("city"),
        c("n_name").alias("country"),
    )


def _products(read: Read) -> DataFrame:
    return read("part").select(
        c("p_partkey").alias("product_id"),
        c("p_name").alias("product_name"),
        F.concat(c("p_size").cast("string"), F.lit("-"), c("p_type")).alias("quantity_per_unit"),
        c("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(0).alias("discontinued"),
        _brand_number().alias("category_id"),
    )


def _employees(read: Read) -> DataFrame:
    joined = read("supplier").join(
        read("nation").select("n_nationkey", "n_name"), c("s_nationkey") == c("n_nationkey"), "left"
    )
    manager = F.when(c("s_suppkey") != 0, F.expr("s_suppkey div 10")).cast("int")
    return joined.select(
        c("s_suppkey").alias("employee_id"),
        c("s_name").alias("employee_name"),
        F.lit("SALES").alias("title"),
        c("s_nationkey").cast("string").alias("city"),
        c("n_name").alias("country"),
        manager.alias("manager_id"),
    )


def _shippers(read: Read) -> DataFrame:
    return (
        read("orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("shipper_id"),
            F.substring("o_orderpriority", 3, 100).alias("shipping_company_name"),
        )
    )


def _categories(read: Read) -> DataFrame:
    return (
        read("part")
        .groupBy("p_brand")
        .agg(F.min("p_type").alias("description"))
        .select(
            _brand_number().alias("category_id"),
            c("p_brand").alias("category_name"),
            "description",
        )
    )


def _brand_number():
    return F.substring("p_brand", 7, 10).cast("int")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source-system view of the retail tables, with the defects cleaning must handle."""
    t = retail_tables(spark, sf_dir)
    ids = {name: _padded(name) for name in ("order_id", "product_id", "category_id")}
    tables = {
        "order_details": t["order_details"].select(
            # A line without quantity above 49 pieces lost its order id.
            F.when(c("quantity") < 50, ids["order_id"]).alias("orderID"),
            ids["product_id"].alias("productID"),
            c("unit_price").cast("string").alias("unitPrice"),
            F.concat(c("quantity").cast("string"), F.lit(".0")).alias("quantity"),
            F.when(c("discount") > 0, c("discount").cast("string"))
            .otherwise(F.lit("none"))
            .alias("discount"),
        ),
        "orders": t["orders"].select(
            F.when(c("delivery_status") != "PENDING", ids["order_id"]).alias("orderID"),
            c("customer_id").alias("customerID"),
            c("employee_id").cast("string").alias("employeeID"),
            c("order_date").cast("string").alias("orderDate"),
            # Orders of the first shipper carry a time in the required date.
            F.when(
                c("shipper_id") == 1, F.concat(c("required_date").cast("string"), F.lit(" 10:00:00"))
            )
            .otherwise(c("required_date").cast("string"))
            .alias("requiredDate"),
            c("shipped_date").cast("string").alias("shippedDate"),
            F.when(c("shipper_id") == 5, F.lit("n/a"))
            .otherwise(c("shipper_id").cast("string"))
            .alias("shipperID"),
            c("freight").cast("string").alias("freight"),
        ),
        "customers": t["customers"].select(
            F.when(c("contact_name") != "MACHINERY", c("customer_id")).alias("customerID"),
            _broken("company").alias("companyName"),
            _broken("contact_name").alias("contactName"),
            c("contact_title").alias("contactTitle"),
            _broken("city").alias("city"),
            F.concat(F.lit(" "), c("country")).alias("country"),
        ),
        "products": t["products"].select(
            ids["product_id"].alias("productID"),
            _broken("product_name").alias("productName"),
            F.concat(F.lit("  "), c("quantity_per_unit"), F.lit("  BOXES - 20 ")).alias(
                "quantityPerUnit"
            ),
            F.concat(c("unit_price").cast("string"), F.lit("5")).alias("unitPrice"),
            c("discontinued").cast("string").alias("discontinued"),
            ids["category_id"].alias("categoryID"),
        ),
        "employees": t["employees"].select(
            c("employee_id").cast("string").alias("employeeID"),
            c("employee_name").alias("employeeName"),
            F.concat(F.lit(" "), c("title")).alias("title"),
            "city",
            "country",
            c("manager_id").cast("string").alias("reportsTo"),
        ),
        "shippers": t["shippers"].select(
            F.when(c("shipper_id") < 5, c("shipper_id").cast("string")).alias("shipperID"),
            c("shipping_company_name").alias("companyName"),
        ),
        "categories": t["categories"].select(
            ids["category_id"].alias("categoryID"),
            F.concat(F.lit("  "), c("category_name"), F.lit(" ")).alias("categoryName"),
            F.concat(c("description"), F.lit("  ")).alias("description"),
        ),
    }
    return {name: _twice(df) for name, df in tables.items()}


def _twice(df: DataFrame) -> DataFrame:
    return df.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")


def _padded(name: str):
    return F.concat(F.lit("  "), c(name).cast("string"), F.lit(" "))


def _broken(name: str):
    return F.concat(F.lit("  "), F.lower(c(name)), F.lit(REPLACEMENT_CHAR), F.lit(" "))
