"""Row counts and fingerprints: as a query over tables, or taken while a table is written.

A fingerprint tells tables of different rows apart, whatever the order of the
rows: their number, and sum and exclusive-or of a digest of each row. The sum
notices rows that are there twice, which cancel each other in the exclusive-or.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Hex digits of a row's digest: 52 bits, whose sum fits DECIMAL(38) for any table.
_DIGEST_DIGITS = 13


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for each table; one job, no column is read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.col("n_rows")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds its row count after the next action."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def row_digest(columns: Sequence[str]) -> Column:
    """A number for a row's values: each as its byte count and text, ``-`` for NULL.

    Columns go by their names, so that their order does not matter either.
    """
    parts = []
    for name in sorted(columns):
        text = F.col(f"`{name}`").cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    digits = F.substring(F.md5(F.concat(*parts).cast("binary")), 1, _DIGEST_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def fingerprint_columns(columns: Sequence[str]) -> list[Column]:
    """n_rows, digest_sum and digest_xor, as aggregates."""
    digest = row_digest(columns)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("digest_sum"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("digest_xor"),
    ]


def fingerprints(tables: Mapping[str, DataFrame], leave_out: Sequence[str] = ()) -> DataFrame:
    """(table_name, n_rows, digest_sum, digest_xor) for each table, in one job.

    ``leave_out``: columns that differ from run to run, such as load times. Rows
    are summed in each task; one row per task and table is shuffled.
    """
    found = [
        df.agg(*fingerprint_columns([c for c in df.columns if c not in leave_out])).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, found)


def fingerprinted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds its fingerprint after the next action."""
    observation = Observation()
    return df.observe(observation, *fingerprint_columns(df.columns)), observation


class ChangedOutput(ValueError):
    """A table does not hold the rows that were written to it."""


def require_same(written: Mapping[str, Mapping], tables: Mapping[str, DataFrame]) -> None:
    """Fail unless every table has the fingerprint that its write observed."""
    found = {r["table_name"]: r.asDict() for r in fingerprints(tables).collect()}
    changed = [name for name, was in written.items() if dict(was) != {k: found[name][k] for k in was}]
    if changed:
        raise ChangedOutput(f"not what was written: {', '.join(sorted(changed))}")


class MissingOutput(ValueError):
    """A layer that should hold rows is empty."""


def require_rows(counts: Mapping[str, int]) -> None:
    empty = sorted(name for name, n in counts.items() if n == 0)
    if empty:
        raise MissingOutput(f"no rows in: {', '.join(empty)}")
