"""Column expressions: every one takes and returns a ``Column``."""

from orderloom.functions.measures import (
    DELIVERY_STATUSES,
    delivery_status,
    line_total,
    net_sales,
    round_money,
    year_month_label,
)
from orderloom.functions.parsing import to_decimal, to_int, to_iso_date, to_text
from orderloom.functions.text import clean_name, pack_size, strip_replacement_char, upper_trimmed

__all__ = [
    "DELIVERY_STATUSES",
    "clean_name",
    "delivery_status",
    "line_total",
    "net_sales",
    "pack_size",
    "round_money",
    "strip_replacement_char",
    "to_decimal",
    "to_int",
    "to_iso_date",
    "to_text",
    "upper_trimmed",
    "year_month_label",
]
