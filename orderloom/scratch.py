"""Folders for intermediate tables, below the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, whose driver and executors share one disk, may do
    without: it uses the temporary folder.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
    return tempfile.gettempdir()


def new_scratch(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return path


def written(spark: SparkSession, df, path: str):
    """``df`` by way of files: later reads neither recompute it nor lose it with an executor."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
