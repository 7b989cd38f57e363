"""Catalog tables from DataFrames."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.audit import counted
from orderloom.sinks.parallel import in_parallel
from orderloom.sources.layers import layer_path

_VERSION = "version-"


def publish_at_path(df: DataFrame, table: str, path: str) -> int:
    """Replace a table whose parquet files live below ``path``; returns its row count.

    The new rows are written to a folder of their own, and only then is the table
    pointed at it, in one step of the catalog: readers see the old report or the
    new one, and a write that fails leaves the old one as it was. The version
    before stays for those who are reading it; older ones, and those of failed
    writes, are removed. Where the columns have changed the table is defined anew.
    """
    spark = df.sparkSession
    before = table_location(spark, table)
    version = f"{path.rstrip('/')}/{_VERSION}{uuid.uuid4().hex}"
    observed, rows = counted(df)
    observed.write.parquet(version)
    if before is not None and _columns(spark.table(table)) == _columns(df):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=version, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(table)
    _remove_versions(spark, path, {_name(version), _name(before or "")})
    return rows.get["n_rows"]


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder that a table reads, or None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _remove_versions(spark: SparkSession, path: str, keep: set[str]) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in filesystem.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith(_VERSION) and name not in keep:
            filesystem.delete(found.getPath(), True)


def publish_all(tables: Mapping[str, DataFrame], database: str, root: str) -> dict[str, int]:
    spark = next(iter(tables.values())).sparkSession
    return in_parallel(
        spark,
        {
            name: partial(publish_at_path, df, f"{database}.{name}", layer_path(root, name))
            for name, df in tables.items()
        },
    )


def publish_managed(df: DataFrame, table: str) -> int:
    """Replace a table whose files the catalog manages."""
    observed, rows = counted(df)
    observed.write.mode("overwrite").format("parquet").saveAsTable(table)
    df.sparkSession.catalog.refreshTable(table)
    return rows.get["n_rows"]
