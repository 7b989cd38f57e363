"""Reports from pre-aggregations against plain groupings of the joined star."""

from __future__ import annotations

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import year_month_label
from orderloom.operators.skew import (
    KeyLoads,
    SkewPolicy,
    heavy_keys,
    join_one_per_key,
    key_loads,
)
from orderloom.operators.star import (
    DIMENSIONS,
    SalesStar,
    base_sales,
    base_sales_count,
    order_totals,
)
from orderloom.plans.gold import REPORTS, Totals
from orderloom.sources.sample_tables import retail_tables

c = F.col

POLICIES = {
    "plain": SkewPolicy(),
    # Any key with more than five rows counts as heavy.
    "heavy": SkewPolicy(share=0.02, min_rows=5),
    "no broadcast of repeats": SkewPolicy(share=0.02, min_rows=5, broadcast_bytes=0),
    # Keys of more than three rows are split; those of more than ten are heavy.
    "split": SkewPolicy(share=0.03, min_rows=10, rows_per_task=3),
}


def dirty_tables(spark, seed=7):
    """Repeated and missing keys in every table, and a third of the rows under one id."""
    rnd = random.Random(seed)

    def maybe(value, p=0.15):
        return None if rnd.random() < p else value

    def order_id():
        return 0 if rnd.random() < 0.33 else rnd.randint(1, 40)

    lines = [
        (
            maybe(order_id(), 0.03),
            maybe(rnd.randint(0, 9), 0.05),
            maybe(Decimal(rnd.randint(1, 9999)) / 100, 0.05),
            maybe(rnd.randint(1, 50), 0.05),
            maybe(Decimal(rnd.randint(0, 30)) / 100),
        )
        for _ in range(300)
    ]
    orders = [
        (
            maybe(order_id(), 0.03),
            maybe(rnd.choice("ABCDE")),
            maybe(rnd.randint(0, 4)),
            maybe(rnd.randint(0, 3)),
            maybe(f"2024-{rnd.randint(1, 12):02d}-15"),
            rnd.choice(["PENDING", "ON_TIME", None]),
            maybe(Decimal(rnd.randint(1, 9999)) / 100),
        )
        for _ in range(60)
    ]
    # Customer A twice with equal report columns, B twice with different ones.
    customers = [
        *[("A", "a", "x", "t1", "c", "d"), ("A", "a", "x", "t2", "c", "d")],
        *[("B", "b", "x", "t", "c", "d"), ("B", "b2", "x", "t", "c", "d")],
        *[("UNKNOWN", f"u{i}", "x", "t", "c", "d") for i in range(20)],
        *[("C", None, None, None, None, None), (None, "n", "x", "t", "c", "d")],
    ]
    products = [(i, f"p{i}", "q", None, 0, i % 3) for i in (0, 0, 1, 2, 3, 3, 3, 4, 5)]
    employees = [(i, f"e{j}", "t", "c", "d", 0) for j, i in enumerate((0, 0, 1, 2, 2, 3))]
    shippers = [(0, "s"), (0, "s2"), (1, "s1"), (2, "s2")]
    return {
        "order_details": spark.createDataFrame(
            lines,
            "order_id int, product_id int, unit_price decimal(10,2), quantity int, "
            "discount decimal(5,2)",
        ),
        "orders": spark.createDataFrame(
            orders,
            "order_id int, customer_id string, employee_id int, shipper_id int, "
            "order_date string, delivery_status string, freight decimal(10,2)",
        ).withColumn("order_date", F.to_date("order_date")),
        "customers": spark.createDataFrame(
            customers,
            "customer_id string, company string, contact_name string, contact_title string, "
            "city string, country string",
        ),
        "products": spark.createDataFrame(
            products,
            "product_id int, product_name string, quantity_per_unit string, "
            "unit_price decimal(10,2), discontinued int, category_id int",
        ),
        "employees": spark.createDataFrame(
            employees,
            "employee_id int, employee_name string, title string, city string, country string, "
            "manager_id int",
        ),
        "shippers": spark.createDataFrame(shippers, "shipper_id int, shipping_company_name string"),
    }


def _plain(base, orders, name):
    money = F.round(F.sum("net_sales"), 2)
    customer = ("customer_id", "company", "contact_name", "customer_city", "customer_country")
    product = ("product_id", "product_name", "category_id")
    employee = ("employee_id", "employee_name", "title", "employee_city", "employee_country")
    carrier = ("shipper_id", "shipping_company_name")
    if name == "report_top_customers":
        report = base.groupBy(*customer).agg(money.alias("total_spend"))
        return report.orderBy(c("total_spend").desc_nulls_last(), *customer).limit(10)
    if name == "report_top_products":
        report = base.groupBy(*product).agg(
            F.sum("quantity").alias("total_quantity_sold"), money.alias("total_product_revenue")
        )
        return report.orderBy(c("total_product_revenue").desc_nulls_last(), *product).limit(10)
    if name == "report_sales_by_employee":
        return base.groupBy(*employee).agg(
            money.alias("total_sales"), F.count_distinct("order_id").alias("total_orders_handled")
        )
    if name == "report_monthly_sales_trend":
        year, month = F.year("order_date"), F.month("order_date")
        return base.groupBy(
            year.alias("sales_year"),
            month.alias("sales_month"),
            year_month_label(year, month).alias("sales_year_month"),
        ).agg(money.alias("monthly_sales"))
    if name == "report_sales_by_shipping_company":
        return base.groupBy(*carrier).agg(
            money.alias("total_sales"), F.count_distinct("order_id").alias("total_orders")
        )
    if name == "report_orders_by_delivery_status":
        return orders.groupBy("delivery_status").agg(
            F.count("order_id").alias("total_orders"),
            F.round(F.sum("freight"), 2).alias("total_freight"),
        )
    return base.agg(
        money.alias("total_revenue"),
        *(
            F.count_distinct(f"{key}_id").alias(f"total_{key}s")
            for key in ("order", "customer", "product", "employee")
        ),
    )


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    return {name: df.cache() for name, df in dirty_tables(spark).items()}


@pytest.fixture(scope="module")
def expected(tables):
    base = base_sales(SalesStar.of(tables)).cache()
    plain = {name: _plain(base, tables["orders"], name) for name in REPORTS}
    return {name: (sorted(df.columns), rows_of(df)) for name, df in plain.items()}


# Plans that split keys are long: they are run where every kind of total is in use.
_LONG = (("report_top_products", "no broadcast of repeats"), ("report_top_products", "split"), ("report_kpi_summary", "split"))


@pytest.mark.parametrize(
    ("name", "policy"),
    [(name, policy) for name in REPORTS for policy in ("plain", "heavy")]
    + list(_LONG),
)
def test_report_equals_plain_grouping(tables, expected, name, policy):
    found = REPORTS[name](Totals(SalesStar.of(tables, POLICIES[policy])), ordered=False)
    assert (sorted(found.columns), rows_of(found)) == expected[name]


@pytest.mark.parametrize("policy", POLICIES)
def test_rows_of_the_base_are_counted_without_it(tables, policy):
    star = SalesStar.of(tables, POLICIES[policy])
    assert base_sales_count(star).first()["n_rows"] == base_sales(star).count()
    empty = SalesStar.of(tables | {"orders": tables["orders"].limit(0)})
    assert base_sales_count(empty).first()["n_rows"] == 0


@pytest.mark.parametrize("policy", POLICIES)
def test_base_per_order_equals_its_grouping(tables, policy):
    star = SalesStar.of(tables, POLICIES[policy])
    grouped = base_sales(star).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("net_sales").alias("net_sales")
    )
    found = base_sales(star, per_order=True)
    assert found.dtypes == grouped.dtypes
    assert rows_of(found) == rows_of(grouped)


def test_base_per_order_makes_no_pairs(spark, tables):
    """A hundred thousand lines and as many headers under one id would make 10^10 rows."""
    n = 100_000
    lines = spark.range(n).selectExpr(
        "0 order_id", "1 product_id", "2.00BD unit_price", "1 quantity", "0.00BD discount"
    )
    headers = spark.range(n).selectExpr(
        "0 order_id", "cast(id as string) customer_id", "1 employee_id", "1 shipper_id",
        "date'2024-01-01' order_date", "'PENDING' delivery_status", "1.00BD freight",
    )
    unique = {name: tables[name].dropDuplicates([key]) for name, key in DIMENSIONS.items()}
    star = SalesStar.of({"order_details": lines, "orders": headers} | unique)
    found = base_sales(star, per_order=True).first()
    assert tuple(found) == (0, n * n, Decimal(2 * n * n))


def test_fixture_is_as_dirty_as_it_claims(tables):
    star = SalesStar.of(tables, POLICIES["heavy"])
    assert all(star.dimensions[name].repeated for name in DIMENSIONS)
    assert 0 in star.loads_in_orders.heavy and 0 in star.loads_in_lines.heavy
    split = SalesStar.of(tables, POLICIES["split"])
    assert split.loads_in_orders.heavy and split.loads_in_lines.heavy
    assert len(split.loads_in_lines.split) > 5 and max(split.loads_in_lines.split.values()) > 1
    assert star.dimensions["customers"].heavy == ("UNKNOWN",)


@pytest.mark.parametrize("name", REPORTS)
def test_ordered_reports_have_the_same_rows(tables, expected, name):
    assert rows_of(REPORTS[name](Totals(SalesStar.of(tables)))) == expected[name][1]


def test_sorts(tables):
    totals = Totals(SalesStar.of(tables))
    sales = [r["total_sales"] for r in REPORTS["report_sales_by_employee"](totals).collect()]
    known = [s for s in sales if s is not None]
    assert sales == sorted(known, reverse=True) + [None] * (len(sales) - len(known))
    months = [tuple(r)[:2] for r in REPORTS["report_monthly_sales_trend"](totals).collect()]
    assert months[0] == (None, None)
    assert months[1:] == sorted(months[1:])


def test_kpi_of_nothing_is_one_row(tables):
    empty = tables | {"order_details": tables["order_details"].limit(0)}
    assert tuple(REPORTS["report_kpi_summary"](Totals(SalesStar.of(empty))).first()) == (
        None,
        0,
        0,
        0,
        0,
    )


def test_missing_order_ids_meet_each_other(spark, tables):
    """One line and one order without id join under the stand-in id 0."""
    lines = tables["order_details"].limit(1).withColumn("order_id", F.lit(0))
    orders = tables["orders"].limit(1).withColumn("order_id", F.lit(0))
    star = SalesStar.of(tables | {"order_details": lines, "orders": orders})
    assert order_totals(star).count() == 1


def test_lines_are_shuffled_once_and_only_in_needed_columns(spark, sf_dir):
    star = SalesStar.of(retail_tables(spark, sf_dir))
    report = REPORTS["report_top_customers"](Totals(star))
    report.collect()
    # The totals are needed twice, and their shuffle is reused.
    physical = report._jdf.queryExecution().executedPlan().toString()
    physical = physical.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in physical
    scans = [line for line in physical.splitlines() if "lineitem.parquet" in line]
    assert len(scans) == 1
    assert "l_shipdate" not in scans[0].split("ReadSchema")[1]
    # The partial sum comes before the exchange on the order id.
    assert "partial_sum(net_sales" in physical
    assert "TakeOrderedAndProject" in physical
    assert "CartesianProduct" not in physical and "BroadcastNestedLoop" not in physical


# ---- skew ----------------------------------------------------------------


@pytest.mark.parametrize(("name", "dimension"), [("report_top_customers", "customer"), ("report_top_products", "part")])
def test_tops_are_cut_before_the_dimension_is_joined(spark, sf_dir, name, dimension):
    star = SalesStar.of(retail_tables(spark, sf_dir))
    report = REPORTS[name](Totals(star))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # The dimension meets ten keys by broadcast, and only the rows that match go on.
    assert plan.count("GlobalLimit 10") >= 2
    assert "LeftSemi" in plan and "strategy=broadcast" in plan
    physical = report._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical.split(f"{dimension}.parquet")[-1]
    # With every key there twice, the sums double and the cut comes after the join.
    table = "customers" if dimension == "customer" else "products"
    doubled = replace(star, **{table: getattr(star, table).unionAll(getattr(star, table))})
    amount = report.columns[-1]
    twice = REPORTS[name](Totals(doubled)).withColumn(amount, c(amount) / 2).select(amount)
    assert [float(r[0]) for r in twice.collect()] == [float(r[0]) for r in report.select(amount).collect()]


def test_kpi_reads_the_lines_twice(spark, sf_dir):
    report = REPORTS["report_kpi_summary"](Totals(SalesStar.of(retail_tables(spark, sf_dir))))
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) <= 2


def test_rows_without_a_key_stay_out_of_the_shuffle(spark):
    many = spark.createDataFrame([(None, i) for i in range(900)] + [(1, 1), (2, 2)], "k int, v int")
    one = spark.createDataFrame([(1, "a"), (3, "c")], "k int, w string")
    joined = join_one_per_key(many, one, "k", [], keep_all_of="many")
    assert joined.count() == 902
    assert sorted(r["v"] for r in joined.where("w is not null").collect()) == [1]
    assert joined.where("k is null and w is null").count() == 900


def test_heavy_keys(spark):
    df = spark.range(1000).select(F.when(c("id") < 400, 7).otherwise(c("id")).alias("k"))
    assert heavy_keys(df, "k", SkewPolicy(share=0.1, min_rows=10)) == [7]
    assert heavy_keys(df, "k", SkewPolicy(share=0.1, min_rows=500)) == []
    assert heavy_keys(df, "k", SkewPolicy()) == []
    text = df.select(c("k").cast("string").alias("k"))
    assert heavy_keys(text, "k", SkewPolicy(share=0.1, min_rows=10)) == ["7"]
    unknown = df.select(F.when(c("k") != 7, c("k")).alias("k"))
    assert heavy_keys(unknown, "k", SkewPolicy(share=0.1, min_rows=10)) == []


@pytest.mark.parametrize("keep", [None, "many", "one"])
def test_split_join_equals_plain_join(spark, keep):
    many = spark.createDataFrame(
        [(k, i) for i, k in enumerate([1] * 20 + [2, 3, 3, None, 9])], "k int, m int"
    )
    one = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e"), (None, "n")], "k int, o string")
    plain = rows_of(join_one_per_key(many, one, "k", [], keep).select("k", "m", "o"))
    split = join_one_per_key(many, one, "k", [1, 3], keep).select("k", "m", "o")
    assert rows_of(split) == plain
    physical = split._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in physical


@pytest.mark.parametrize("keep", [None, "many", "one"])
def test_join_by_parts_equals_plain_join(spark, keep):
    many = spark.createDataFrame(
        [(k, i) for i, k in enumerate([1] * 20 + [2, 3, 3, None, 9, 9])], "k int, m int"
    )
    one = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e"), (None, "n")], "k int, o string")
    plain = rows_of(join_one_per_key(many, one, "k", [], keep).select("k", "m", "o"))
    loads = KeyLoads((2,), {1: 7, 9: 2})
    assert rows_of(join_one_per_key(many, one, "k", loads, keep).select("k", "m", "o")) == plain


def test_a_key_below_the_heavy_share_is_joined_by_several_tasks(spark):
    many = spark.range(3000).select(F.when(c("id") < 900, 7).otherwise(c("id")).alias("k"), c("id").alias("v"))
    one = spark.range(3000).select(c("id").alias("k"), (c("id") * 2).alias("w"))
    policy = SkewPolicy(share=0.9, min_rows=2000, rows_per_task=100)
    loads = key_loads(many, "k", policy)
    assert (loads.heavy, loads.split) == ((), {7: 9})
    forced = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        for found, least in ((loads, 4), (KeyLoads(), 1)):
            joined = join_one_per_key(many, one, "k", found)
            tasks = joined.where("k = 7").select(F.spark_partition_id().alias("task"))
            assert tasks.distinct().count() >= least
            assert found.split or tasks.distinct().count() == 1
            assert joined.count() == 2101 + 900 - 1
    finally:
        for name in forced:
            spark.conf.unset(name)


def test_kpi_copies_no_rows(spark, sf_dir):
    report = REPORTS["report_kpi_summary"](Totals(SalesStar.of(retail_tables(spark, sf_dir))))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan


def test_base_splits_skewed_partitions_at_run_time(spark):
    """The hot id of lines and orders is joined by several tasks, with the same rows."""
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    tables = dirty_tables(spark)
    tables |= {name: tables[name].repartition(8) for name in ("order_details", "orders")}
    expected = rows_of(base_sales(SalesStar.of(tables)))
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        base = base_sales(SalesStar.of(tables))
        found = rows_of(base)
        base.collect()
        final = base._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in forced:
            spark.conf.unset(name)
    assert found == expected
    assert "skew=true" in final
