"""Column functions on the edge rows of each rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom import functions as fn

c = F.col


def applied(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(c("v"))).collect()]


@pytest.mark.parametrize(
    "text, as_int, as_bigint",
    [
        ("7", 7, 7),
        (" 12 ", 12, 12),
        ("+3", 3, 3),
        ("", None, None),
        ("x", None, None),
        ("1.5", 1, 1),
        ("-1.5", -1, -1),
        ("1.", 1, 1),
        (".5", 0, 0),
        ("1.9999999999", 1, 1),
        ("1e3", None, None),
        ("1.2.3", None, None),
        ("2147483647", 2147483647, 2147483647),
        ("2147483648", None, 2147483648),
        ("-2147483648.9", -2147483648, -2147483648),
        ("99999999999", None, 99999999999),
        ("9" * 45, None, None),
        (None, None, None),
    ],
)
def test_numerals_to_int(spark, text, as_int, as_bigint):
    assert applied(spark, [text], fn.to_int) == [as_int]
    assert applied(spark, [text], lambda v: fn.to_int(v, "bigint")) == [as_bigint]


def test_numbers_to_int(spark):
    assert applied(spark, [7.9, -7.9, None], fn.to_int, "double") == [7, -7, None]
    assert applied(spark, [2**31, 5], fn.to_int, "bigint") == [None, 5]
    assert applied(spark, [Decimal("3.99")], fn.to_int, "decimal(5,2)") == [3]


@settings(
    max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.one_of(
            st.from_regex(r"\A[+-]?\d{1,22}(\.\d{0,4})?\Z"),
            st.text(alphabet="0123456789.+-ex ", max_size=8),
        ),
        min_size=50,
        max_size=100,
    )
)
def test_numerals_parse_as_spark_casts_them_without_ansi(spark, texts):
    """The rule written here against the cast it stands for."""
    ours = applied(spark, texts, lambda v: fn.to_int(v, "bigint"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        cast = applied(spark, texts, lambda v: v.cast("bigint"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    # A lone point or sign is not a number here.
    odd = {".", "+.", "-."}
    assert [o for o, t in zip(ours, texts) if t.strip() not in odd] == [
        x for x, t in zip(cast, texts) if t.strip() not in odd
    ]


def test_to_decimal(spark):
    texts = ["2.345", "-2.345", "123456789012", "12", "x", None]
    expected = [Decimal("2.35"), Decimal("-2.35"), None, Decimal("12.00"), None, None]
    assert applied(spark, texts, lambda v: fn.to_decimal(v, 10, 2)) == expected


def test_to_iso_date(spark):
    day = dt.date(2024, 1, 5)
    texts = ["2024-01-05", "2024-1-5", "2024-01-05 10:00:00", "2024-02-30", "bad", " 2024-01-05", None]
    assert applied(spark, texts, fn.to_iso_date) == [day, *[None] * 6]
    assert applied(spark, [day, None], fn.to_iso_date, "date") == [day, None]
    assert applied(spark, [dt.datetime(2024, 1, 5, 10)], fn.to_iso_date, "timestamp") == [day]


def test_text(spark):
    assert applied(spark, ["Caf� ", "  a�b ", "\tx", None], fn.clean_name) == [
        "CAF",
        "AB",
        "\tX",
        None,
    ]
    assert applied(spark, [" ACME ", "straße"], fn.upper_trimmed) == ["ACME", "STRASSE"]


def test_pack_size(spark):
    texts = ["10 boxes-20 bags", " 10 - 500 G ", "1\t kg", "a-b-c", None]
    expected = ["10 boxes x 20 bags", "10 x 500 g", "1 kg", "a x b x c", None]
    assert applied(spark, texts, fn.pack_size) == expected


def test_delivery_status(spark):
    day, later = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    rows = [(0, None, day), (1, day, day), (2, later, day), (3, day, None), (4, None, None)]
    df = spark.createDataFrame(rows, "i int, shipped date, required date").orderBy("i")
    found = [r[0] for r in df.select(fn.delivery_status(c("shipped"), c("required"))).collect()]
    assert found == ["PENDING", "ON_TIME", "DELAYED", "DELAYED", "PENDING"]


def test_amounts(spark):
    rows = [(0, Decimal("5.00"), 10, Decimal("0.10")), (1, Decimal("20.00"), 2, None)]
    df = spark.createDataFrame(rows, "i int, p decimal(10,2), q int, d decimal(5,2)").orderBy("i")
    gross = [r[0] for r in df.select(fn.line_total(c("p"), c("q"))).collect()]
    net = [r[0] for r in df.select(fn.net_sales(c("p"), c("q"), c("d"))).collect()]
    assert gross == [Decimal("50.00"), Decimal("40.00")]
    assert net == [Decimal("45.00"), None]


def test_round_money_is_half_up_away_from_zero(spark):
    values = [Decimal("0.125"), Decimal("-0.125"), Decimal("0.135")]
    assert applied(spark, values, fn.round_money, "decimal(6,3)") == [
        Decimal("0.13"),
        Decimal("-0.13"),
        Decimal("0.14"),
    ]


def test_year_month_label(spark):
    days = [dt.date(2024, 3, 1), dt.date(2024, 12, 1), None]
    label = applied(spark, days, lambda v: fn.year_month_label(F.year(v), F.month(v)), "date")
    assert label == ["2024-03", "2024-12", ""]
