"""Parquet layers: one directory per table, replaced as a whole."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame

from orderloom.operators.audit import counted, fingerprinted
from orderloom.sinks.parallel import in_parallel
from orderloom.sources.layers import layer_path


def write_layer(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Replace every table below ``root``; rows are counted by the write itself.

    The tables must not be read from ``root``: a directory cannot be replaced
    while it is read.
    """
    spark = next(iter(tables.values())).sparkSession
    return in_parallel(
        spark, {t: partial(replace_parquet, df, layer_path(root, t)) for t, df in tables.items()}
    )


def write_layer_with_fingerprints(tables: Mapping[str, DataFrame], root: str) -> dict[str, dict]:
    """As ``write_layer``, but each table's number of rows comes with their digests.

    The digests are taken from the rows on their way to the files, without a
    second pass; ``operators.audit.require_same`` compares them with what the
    files hold.
    """
    spark = next(iter(tables.values())).sparkSession

    def write(df: DataFrame, path: str) -> dict:
        observed, found = fingerprinted(df)
        observed.write.mode("overwrite").parquet(path)
        return found.get

    return in_parallel(spark, {t: partial(write, df, layer_path(root, t)) for t, df in tables.items()})


def replace_parquet(df: DataFrame, path: str) -> int:
    observed, rows = counted(df)
    observed.write.mode("overwrite").parquet(path)
    return rows.get["n_rows"]


def append_parquet(df: DataFrame, path: str) -> int:
    observed, rows = counted(df)
    observed.write.mode("append").parquet(path)
    return rows.get["n_rows"]
