"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# U+FFFD is what a decoder leaves where bytes were not valid text.
REPLACEMENT_CHAR = "�"
PACK_SEPARATOR = "-"
PACK_JOINER = " x "


def strip_replacement_char(text: Column) -> Column:
    return F.replace(text, F.lit(REPLACEMENT_CHAR), F.lit(""))


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))


def clean_name(text: Column) -> Column:
    """Upper-case name without broken characters and outer spaces."""
    return upper_trimmed(strip_replacement_char(text))


def pack_size(text: Column) -> Column:
    """'10 Boxes-20 bags' → '10 boxes x 20 bags', with single spaces throughout."""
    joined = F.replace(F.lower(F.trim(text)), F.lit(PACK_SEPARATOR), F.lit(PACK_JOINER))
    return F.trim(F.regexp_replace(joined, r"\s+", " "))
