"""Lenient parsing: input that does not parse becomes NULL, also under ANSI mode.

``try_cast`` of text is right but slow where it fails: Spark raises and catches
an exception per value, which on dirty columns costs more than all other work.
Text is therefore matched against the accepted form first, and only what fits
is cast. No part of a pattern can give back what it has taken, so it is not
tried twice. ``typeof`` is folded when the query is planned, so typed input pays
for none of this.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date form, and per integer type the number of
# digits that always fit and the range.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_INTEGERS = {"int": (9, -(2**31), 2**31 - 1), "bigint": (18, -(2**63), 2**63 - 1)}


def to_int(value: Column, type_name: str = "int") -> Column:
    """Integer value of a number or numeral; a fraction is cut off.

    Numerals may have outer white space and a sign but no exponent. Values out
    of range are NULL, never wrapped.
    """
    return F.when(_is_text(value), _int_from_text(value.cast("string"), type_name)).otherwise(
        value.try_cast(type_name)
    )


def _int_from_text(text: Column, type_name: str) -> Column:
    digits, low, high = _INTEGERS[type_name]
    # Nearly all values: few enough digits to fit whatever they are. ``conv`` gives back what is
    # digits alone, which costs a third of the pattern; the cut keeps it within its range.
    bare = F.trim(text)
    plain = F.conv(F.substring(bare, 1, digits), 10, 10) == bare
    # Those with a sign, a fraction, leading zeros or other white space.
    short = text.rlike(rf"^\s*+[+-]?+\d{{1,{digits}}}+(?:\.\d*+)?+\s*+$")
    # The rest: many digits, or none before the point, as in '.5', which is zero.
    numeral = text.rlike(r"^\s*[+-]?(0*\d{1,38}(\.\d*)?|\.\d*)\s*$")
    before_point = F.substring_index(text, ".", 1)
    whole = F.coalesce(before_point.try_cast("decimal(38,0)"), F.lit(0))
    return (
        F.when(plain, bare.try_cast(type_name))
        .when(short, before_point.try_cast(type_name))
        .when(numeral & whole.between(low, high), whole.try_cast(type_name))
    )


def to_decimal(value: Column, precision: int, scale: int) -> Column:
    """Decimal value, rounded half up to ``scale``; NULL where it does not fit.

    Numerals may have outer white space, a sign and an exponent.
    """
    target = f"decimal({precision},{scale})"
    text = value.cast("string")
    numeral = text.rlike(r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$")
    return F.when(_is_text(value), F.when(numeral, text.try_cast(target))).otherwise(
        value.try_cast(target)
    )


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_iso_date(value: Column) -> Column:
    """Date from ISO text (no other layout, no time part) or from a date or timestamp."""
    text = value.cast("string")
    return F.when(_is_text(value), F.when(text.rlike(_ISO_DATE), text.try_cast("date"))).otherwise(
        value.try_cast("date")
    )


def _is_text(value: Column) -> Column:
    return F.typeof(value) == "string"
