"""Amounts, delivery classification and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DELIVERY_STATUSES = ("PENDING", "ON_TIME", "DELAYED")
MONEY_SCALE = 2


def round_money(amount: Column) -> Column:
    """Half up, away from zero, to cents."""
    return F.round(amount, MONEY_SCALE)


def line_total(unit_price: Column, quantity: Column) -> Column:
    """Gross value of an order line; the discount is not applied here."""
    return round_money(unit_price * quantity)


def net_sales(unit_price: Column, quantity: Column, discount: Column) -> Column:
    """Value of an order line after discount; NULL if any input is NULL."""
    return round_money(unit_price * quantity * (F.lit(1) - discount))


def delivery_status(shipped: Column, required: Column) -> Column:
    """An unknown required date counts as missed."""
    pending, on_time, delayed = DELIVERY_STATUSES
    in_time = F.coalesce(shipped <= required, F.lit(False))
    return F.when(shipped.isNull(), pending).otherwise(F.when(in_time, on_time).otherwise(delayed))


def year_month_label(year: Column, month: Column) -> Column:
    """'2024-03'; the empty string, not NULL, where the date is unknown."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
