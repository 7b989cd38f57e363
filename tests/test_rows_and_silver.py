"""Row operators and cleaning plans on small tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import audit, rows
from orderloom.plans import silver
from orderloom.plans.silver import SILVER_PLANS
from orderloom.schemas import SOURCE_NAMES, TABLES, silver_schema

c = F.col


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def parcels(spark):
    """Repeats, zeros and gaps in every column."""
    rows_ = [
        ("p7", 0, 3.5, None),
        ("p7", 0, 3.5, None),
        ("p8", -4, None, "north"),
        (None, 12, 0.0, "south"),
        ("p9", None, -0.25, "north"),
        ("p9", 8, 1e-9, "east"),
        (None, None, None, None),
    ]
    return spark.createDataFrame(rows_, "parcel string, pieces int, weight double, depot string")


def test_rows_with_key(parcels):
    assert values(rows.with_key(parcels, "parcel"), "pieces") == [(-4,), (0,), (0,), (8,), (None,)]
    assert rows.with_key(parcels, "depot").count() == 4


def test_positive_rows(parcels):
    assert values(rows.with_positive(parcels, "weight"), "parcel") == [("p7",), ("p7",), ("p9",)]
    assert values(rows.with_positive(parcels, "pieces"), "pieces") == [(12,), (8,)]


def test_complete_rows(parcels):
    assert values(rows.complete_rows(parcels), "parcel", "pieces") == [("p9", 8)]
    assert rows.complete_rows(parcels, ["parcel", "pieces"]).count() == 4


def test_distinct_rows(parcels):
    assert rows.distinct_rows(parcels).count() == 6


def test_newest_per_key_keeps_one_row_and_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (None, 3)], "k int, v int")
    newest = rows.newest_per_key(df, "k", [c("v").desc()])
    assert values(newest, "k", "v") == [(1, 7), (2, 1), (None, 3)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_renames_skip_absent_columns(spark):
    df = spark.createDataFrame([("1", "x")], "orderID string, other string")
    assert rows.rename_source_columns(df, "orders").columns == ["order_id", "other"]


def test_row_counts(spark):
    df = spark.range(5)
    counts = audit.row_counts({"a": df, "b": df.where("id > 5")})
    assert values(counts, "table_name", "n_rows") == [("a", 5), ("b", 0)]


def test_observed_count(spark):
    df, rows_seen = audit.counted(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert rows_seen.get["n_rows"] == 7


def test_empty_layers_fail():
    audit.require_rows({"a": 1})
    with pytest.raises(audit.MissingOutput, match="b"):
        audit.require_rows({"a": 1, "b": 0})


@pytest.mark.parametrize("table", TABLES)
@pytest.mark.parametrize("key_type", ["int", "bigint"])
def test_plans_keep_their_contract(spark, table, key_type):
    """Columns, order and types, whatever the source types; no rows make no rows."""
    schema = silver_schema(table, key_type)
    source = {new: old for old, new in SOURCE_NAMES[table].items()}
    derived = {"total_price", "delivery_status", "ingestion_timestamp"}
    names = [source.get(f.name, f.name) for f in schema if f.name not in derived]
    raw = spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    cleaned = SILVER_PLANS[table](raw, key_type)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in schema]
    assert cleaned.count() == 0


LINES = "orderID string, productID string, unitPrice string, quantity string, discount string"


def test_copies_are_dropped_before_missing_keys_are_filled(spark):
    raw = spark.createDataFrame(
        [(None, "1", "5", "2", "0"), (None, "1", "5", "2", "0"), ("0", "1", "5", "2", "0")], LINES
    )
    assert values(silver.order_details(raw), "order_id", "total_price") == [
        (0, Decimal("10.00")),
        (0, Decimal("10.00")),
    ]


def test_large_line_totals_are_kept_whole(spark):
    raw = spark.createDataFrame([("1", "1", "99999999.99", "2000000000", "0")], LINES)
    row = silver.order_details(raw).first()
    assert row["total_price"] == Decimal("99999999.99") * 2000000000


def test_copies_are_recognised_on_clean_text(spark):
    columns = (
        "customerID string, companyName string, contactName string, contactTitle string, "
        "city string, country string"
    )
    raw = spark.createDataFrame(
        [
            ("A", " bon app� ", "x", " t ", "paris", " fr "),
            ("A", "BON APP", "X", " t ", "Paris ", " fr "),
            (None, "c", "d", None, None, None),
        ],
        columns,
    )
    cleaned = silver.customers(raw)
    assert values(cleaned, "*") == [
        ("A", "BON APP", "X", " t ", "PARIS", " fr "),
        ("UNKNOWN", "C", "D", None, None, None),
    ]


def test_categories_keep_copies_and_missing_keys(spark):
    raw = spark.createDataFrame(
        [("1", " a ", "b "), ("1", " a ", "b "), (None, "c", "d")],
        "categoryID string, categoryName string, description string",
    )
    assert values(silver.categories(raw), "category_id", "category_name", "description") == [
        (1, "a", "b"),
        (1, "a", "b"),
        (None, "c", "d"),
    ]


def test_orders_fill_only_their_own_id(spark):
    raw = spark.createDataFrame(
        [(None, None, None, "2024-01-05", "2024-1-9", None, None, "3.005")],
        "orderID string, customerID string, employeeID string, orderDate string, "
        "requiredDate string, shippedDate string, shipperID string, freight string",
    )
    row = silver.orders(raw).first()
    assert (row["order_id"], row["customer_id"], row["employee_id"], row["shipper_id"]) == (
        0,
        None,
        None,
        None,
    )
    assert (row["required_date"], row["delivery_status"]) == (None, "PENDING")
    assert row["freight"] == Decimal("3.01")
    assert row["ingestion_timestamp"] is not None


def test_employees_keep_outer_spaces_and_fill_both_ids(spark):
    raw = spark.createDataFrame(
        [(None, " Ann ", "t", "c", "d", None)],
        "employeeID string, employeeName string, title string, city string, country string, "
        "reportsTo string",
    )
    row = silver.employees(raw).first()
    assert (row["employee_id"], row["employee_name"], row["manager_id"]) == (0, " Ann ", 0)
