"""Tables of a relational database over JDBC.

The driver jar, URL and credentials come from the caller (``spark.jars`` and
``options``); nothing about a particular database is kept here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TableReader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class RangeSplit:
    """Parallel read of one table by ranges of an integer, date or timestamp column.

    Bounds set only the stride: rows outside them, and NULLs, are read too, by
    the first and last range. With ``lower`` and ``upper`` left out they are
    asked from the database, as one row.
    """

    column: str
    partitions: int
    lower: object | None = None
    upper: object | None = None


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str],
    split: RangeSplit | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """One table; a single task without ``split``, else one task per range."""
    reader = (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("fetchsize", fetch_size)
    )
    if split is not None:
        lower, upper = _bounds(spark, url, table, options, split)
        if lower is not None:
            reader = (
                reader.option("partitionColumn", split.column)
                .option("numPartitions", split.partitions)
                .option("lowerBound", str(lower))
                .option("upperBound", str(upper))
            )
    return reader.option("dbtable", table).load()


def _bounds(spark, url, table, options, split: RangeSplit) -> tuple:
    if split.lower is not None and split.upper is not None:
        return split.lower, split.upper
    query = f"(SELECT MIN({split.column}) AS lo, MAX({split.column}) AS hi FROM {table}) bounds"
    row = (
        spark.read.format("jdbc").options(**options).option("url", url).option("dbtable", query)
    ).load().first()
    return row[0], row[1]


def jdbc_reader(
    spark: SparkSession,
    url: str,
    options: Mapping[str, str],
    schema: str = "",
    splits: Mapping[str, RangeSplit] | None = None,
) -> TableReader:
    """Reader by table name, for the full load."""
    prefix = f"{schema}." if schema else ""

    def read(table: str) -> DataFrame:
        return jdbc_table(spark, url, f"{prefix}{table}", options, (splits or {}).get(table))

    return read
