"""Row-level operators: renames, filters, null fill, distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schemas import SOURCE_NAMES

# What stands for a missing key.
MISSING_ID = 0
MISSING_CODE = "UNKNOWN"


def rename_source_columns(raw: DataFrame, table: str) -> DataFrame:
    """Source spelling to curated spelling; columns that are absent are skipped."""
    return raw.withColumnsRenamed(SOURCE_NAMES[table])


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def with_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any NULL (in ``columns``)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def fill_missing(df: DataFrame, values: Mapping[str, int | str]) -> DataFrame:
    return df.fillna(dict(values))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct: a hash aggregate that drops copies before the shuffle."""
    return df.dropDuplicates()


def newest_per_key(df: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Make the order total to fix the surviving row. Spark keeps one row per key
    in each task before the shuffle (window group limit), so a key that holds
    a large share of the rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
