"""Refined orders as a catalog table, and its latest rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.events import NO_FILE_TOO_OLD
from orderloom.streaming.refine import refined_schema

# Fixed value: length of the preview.
PREVIEW_ROWS = 20

# Table property with the name of the table's progress.
_PROGRESS = "orderloom.progress"


def publish_orders(
    spark: SparkSession,
    refined: str,
    table: str,
    key_type: str = "int",
    rebuild: bool = False,
    progress: str | None = None,
) -> int:
    """Add the refined orders that the table does not hold yet; returns its row count.

    What is new is what the refinement has committed since: a stream from its
    files to the table's, whose checkpoint and commit logs say which files are
    published. No clock is asked, so rows stamped by a driver whose clock went
    back are published like any other; history is neither read nor written again,
    and a publication that failed half-way is finished by the next one without
    adding a row twice. Files of a failed attempt are not part of the table.

    ``progress`` is the folder of checkpoints, by default beside ``refined``. Each
    table made here has one of its own, which the table names. A table that was
    not made here, or one to ``rebuild``, as is needed after the refined folder
    was made anew, is replaced and filled from the start.
    """
    progress = progress or f"{refined.rstrip('/')}.published"
    name = None if rebuild else _progress_of(spark, table)
    if name is None:
        name = _new_table(spark, table, key_type)
    orders = spark.readStream.schema(refined_schema(key_type)).options(**NO_FILE_TOO_OLD).parquet(refined)
    writer = orders.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer.option("checkpointLocation", f"{progress}/{name}").toTable(table).awaitTermination()
    spark.catalog.refreshTable(table)
    return spark.table(table).count()


def _progress_of(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return properties.get(_PROGRESS)


def _new_table(spark: SparkSession, table: str, key_type: str) -> str:
    """An empty table; its progress is named in the same step, so no table is without."""
    name = uuid.uuid4().hex
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in refined_schema(key_type))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet TBLPROPERTIES ('{_PROGRESS}' = '{name}')")
    return name


def latest_orders(spark: SparkSession, table: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """The ``n`` orders with the highest ids; each task keeps only its own ``n``."""
    return spark.table(table).orderBy(F.col("order_id").desc_nulls_last()).limit(n)
