"""Databases and tables of the session catalog, in memory or Hive-backed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import TABLES, silver_schema
from orderloom.sources.layers import layer_path


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")


def drop_database(spark: SparkSession, database: str) -> None:
    """The database with its tables; files of external tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def use_database(spark: SparkSession, database: str) -> None:
    """For interactive sessions; the library itself uses qualified names."""
    spark.catalog.setCurrentDatabase(database)


def register_external(
    spark: SparkSession,
    database: str,
    root: str,
    tables: Iterable[str] = TABLES,
    key_type: str = "int",
    prefix: str = "silver_",
) -> list[str]:
    """Curated parquet directories as external tables with their declared schema."""
    names = []
    for table in tables:
        name = f"{database}.{prefix}{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(
            name,
            path=layer_path(root, table),
            source="parquet",
            schema=silver_schema(table, key_type),
        )
        names.append(name)
    return names


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_contents(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Every table of a database, by name."""
    return {name: spark.table(f"{database}.{name}") for name in list_tables(spark, database)}


def refresh(spark: SparkSession, table: str) -> None:
    """Forget cached metadata after files were changed outside this session."""
    spark.catalog.refreshTable(table)
