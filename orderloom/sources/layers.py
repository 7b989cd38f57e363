"""Parquet layers and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import TABLES


def layer_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_layer(
    spark: SparkSession, root: str, tables: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """Parquet directories below ``root``, schema from their footers."""
    return {t: spark.read.parquet(layer_path(root, t)) for t in tables}


def read_catalog(
    spark: SparkSession, database: str, tables: Iterable[str] = TABLES, prefix: str = "silver_"
) -> dict[str, DataFrame]:
    return {t: spark.table(f"{database}.{prefix}{t}") for t in tables}
