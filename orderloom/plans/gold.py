"""The seven sales reports.

Each report takes a ``Totals``: the star with its two pre-aggregations, either
as plans (a single report) or read back from tables (all reports of a run).
``ordered=False`` leaves out the final sort of the complete reports, for writes
to tables, which have no row order; the two top lists are always cut by it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import round_money, year_month_label
from orderloom.operators import star as st
from orderloom.operators.star import SalesStar

c = F.col

# Fixed value: length of the top lists.
TOP = 10


@dataclass(frozen=True)
class Totals:
    star: SalesStar
    written_orders: DataFrame | None = None
    written_products: DataFrame | None = None

    @cached_property
    def by_order(self) -> DataFrame:
        if self.written_orders is not None:
            return self.written_orders
        return st.order_totals(self.star)

    @cached_property
    def by_product(self) -> DataFrame:
        if self.written_products is not None:
            return self.written_products
        return st.product_totals(self.star)


def _money(amount: Column) -> Column:
    return round_money(amount).cast(st.TOTAL_TYPE)


def _largest_first(amount: str, *ties: str) -> list[Column]:
    return [c(amount).desc_nulls_last(), *(c(t).asc_nulls_first() for t in ties)]


def _top(t: Totals, totals: DataFrame, dimension: str, order_by: str) -> DataFrame:
    """The first rows of ``totals`` (one per key) with the attributes of ``dimension``.

    Where no key of the dimension is repeated, the totals are cut to the top
    first (ties go by the key, so the cut is exact), and the dimension is only
    searched for those few keys: it is neither shuffled nor sorted. Repeated
    keys add attribute groups, and the cut comes after the join.
    """
    key = st.DIMENSIONS[dimension]
    attributes = st.dimension_attributes(t.star, dimension)
    if t.star.dimensions[dimension].repeated:
        return st.with_attributes(t.star, totals, dimension)
    few = totals.orderBy(*_largest_first(order_by, key)).limit(TOP)
    # At most TOP rows on either side.
    wanted = attributes.join(F.broadcast(few.select(key)), key, "left_semi")
    return few.join(F.broadcast(wanted), key, "left")


def top_customers(t: Totals, ordered: bool = True) -> DataFrame:
    """Ten customers by total spend; ties go by the customer columns."""
    spend = t.by_order.groupBy("customer_id").agg(
        F.sum(st.weighted_sales(t.star, ("employees", "shippers"))).alias("spend")
    )
    # What is compared is the rounded amount.
    spend = spend.withColumn("rounded", _money(c("spend")))
    who = ("customer_id", "company", "contact_name", "customer_city", "customer_country")
    return (
        _top(t, spend, "customers", "rounded")
        .groupBy(*who)
        .agg(_money(F.sum("spend")).alias("total_spend"))
        .orderBy(*_largest_first("total_spend", *who))
        .limit(TOP)
    )


def top_products(t: Totals, ordered: bool = True) -> DataFrame:
    """Ten products by revenue; ties go by the product columns."""
    what = ("product_id", "product_name", "category_id")
    totals = t.by_product.withColumn("rounded", _money(c("net_sales")))
    return (
        _top(t, totals, "products", "rounded")
        .groupBy(*what)
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            _money(F.sum("net_sales")).alias("total_product_revenue"),
        )
        .orderBy(*_largest_first("total_product_revenue", *what))
        .limit(TOP)
    )


def sales_by_employee(t: Totals, ordered: bool = True) -> DataFrame:
    handled = t.by_order.groupBy("employee_id").agg(
        F.sum(st.weighted_sales(t.star, ("customers", "shippers"))).alias("sales"),
        F.count_distinct("order_id").alias("n_orders"),
    )
    who = ("employee_id", "employee_name", "title", "employee_city", "employee_country")
    report = (
        st.with_attributes(t.star, handled, "employees")
        .groupBy(*who)
        .agg(
            _money(F.sum("sales")).alias("total_sales"),
            F.max("n_orders").alias("total_orders_handled"),
        )
    )
    return report.orderBy(*_largest_first("total_sales", *who)) if ordered else report


def monthly_sales_trend(t: Totals, ordered: bool = True) -> DataFrame:
    """Orders without a date form one group with an empty label."""
    sales = st.weighted_sales(t.star, st.ORDER_DIMENSIONS)
    months = t.by_order.groupBy(
        F.year("order_date").alias("sales_year"), F.month("order_date").alias("sales_month")
    ).agg(_money(F.sum(sales)).alias("monthly_sales"))
    report = months.select(
        "sales_year",
        "sales_month",
        year_month_label(c("sales_year"), c("sales_month")).alias("sales_year_month"),
        "monthly_sales",
    )
    return report.orderBy("sales_year", "sales_month") if ordered else report


def sales_by_shipping_company(t: Totals, ordered: bool = True) -> DataFrame:
    carried = t.by_order.groupBy("shipper_id").agg(
        F.sum(st.weighted_sales(t.star, ("customers", "employees"))).alias("sales"),
        F.count_distinct("order_id").alias("n_orders"),
    )
    who = ("shipper_id", "shipping_company_name")
    report = (
        st.with_attributes(t.star, carried, "shippers")
        .groupBy(*who)
        .agg(
            _money(F.sum("sales")).alias("total_sales"),
            F.max("n_orders").alias("total_orders"),
        )
    )
    return report.orderBy(*_largest_first("total_sales", *who)) if ordered else report


def orders_by_delivery_status(t: Totals, ordered: bool = True) -> DataFrame:
    """Over all orders, with or without lines."""
    report = t.star.orders.groupBy("delivery_status").agg(
        F.count("order_id").alias("total_orders"),
        _money(F.sum("freight")).alias("total_freight"),
    )
    return report.orderBy(*_largest_first("total_orders", "delivery_status")) if ordered else report


# Fixed value: columns of the KPI report.
_KPI_COLUMNS = [
    "total_revenue",
    "total_orders",
    "total_customers",
    "total_products",
    "total_employees",
]


def kpi_summary(t: Totals, ordered: bool = True) -> DataFrame:
    """One row: revenue, and how many orders, customers, products, employees.

    Distinct counts over the joined lines, or over the orders, would copy every
    row once per counted column. Here each is counted where its keys are together
    anyway: orders where they were joined, customers among the pairs of customer
    and employee, to which a task reduces its orders before any is moved, and
    employees among the sums of these. Products are the rows of the product
    totals, so the lines are read twice; the rows are then folded into one.
    """
    revenue = st.weighted_sales(t.star, st.ORDER_DIMENSIONS)
    pairs = t.by_order.groupBy("customer_id", "employee_id").agg(
        F.sum(revenue).alias("revenue"), F.sum("is_first_of_id").alias("orders")
    )
    of_customer = Window.partitionBy("customer_id").orderBy("employee_id")
    is_first = c("customer_id").isNotNull() & (F.row_number().over(of_customer) == 1)
    by_employee = (
        pairs.withColumn("customers", is_first.cast("int"))
        .groupBy("employee_id")
        .agg(*(F.sum(name).alias(name) for name in ("revenue", "orders", "customers")))
    )
    parts = [
        by_employee.agg(
            _money(F.sum("revenue")).alias("total_revenue"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
            F.coalesce(F.sum("customers"), F.lit(0)).alias("total_customers"),
            F.count("employee_id").alias("total_employees"),
        ),
        t.by_product.agg(F.count("product_id").alias("total_products")),
    ]
    if t.star.loads_in_orders.keys:
        # Ids with many orders: as many rows as there are such ids.
        many = t.by_order.where(c("is_first_of_id").isNull()).select("order_id").distinct()
        parts.append(many.agg(F.count(F.lit(1)).alias("more_orders")))
    else:
        parts[0] = parts[0].withColumn("more_orders", F.lit(0).cast("bigint"))
    folded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = folded.agg(*(F.max(name).alias(name) for name in [*_KPI_COLUMNS, "more_orders"]))
    total = c("total_orders") + c("more_orders")
    return counts.withColumn("total_orders", total).select(*_KPI_COLUMNS)


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "report_top_customers": top_customers,
    "report_top_products": top_products,
    "report_sales_by_employee": sales_by_employee,
    "report_monthly_sales_trend": monthly_sales_trend,
    "report_sales_by_shipping_company": sales_by_shipping_company,
    "report_orders_by_delivery_status": orders_by_delivery_status,
    "report_kpi_summary": kpi_summary,
}
