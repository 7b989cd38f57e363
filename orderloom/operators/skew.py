"""Joins that stay balanced when single keys hold a large share of the rows.

Spark splits skewed partitions by itself (adaptive skew join) only where both
join inputs come straight from a shuffle. The joins here have an aggregated
input, one row per key, which rules that out but allows something better. Which
keys hold how many rows is known from a sketch. The few that are heavy, at most
``1 / share`` of them, have their rows of the one-row-per-key input broadcast
whatever the size of the data, and the heavy rows never move. The many that are
not heavy, but more than a task should hold, are dealt to as many tasks as their
rows need, and their row of the other input goes to each of these.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MERGE_GROUPS = 1024


@dataclass(frozen=True)
class SkewPolicy:
    """A key is heavy if it holds more than ``share`` of the rows and ``min_rows``.

    ``share`` bounds the number of heavy keys, and so what is broadcast.
    ``broadcast_bytes`` bounds the list of repeated keys that is broadcast.
    A key that is not heavy is split if it holds more than ``rows_per_task``; of
    more than ``max_split_keys`` such keys those with the most rows are.
    """

    share: float = 0.0005
    min_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    rows_per_task: int = 10_000_000
    max_split_keys: int = 20_000

    @property
    def max_keys(self) -> int:
        return int(1 / self.share)


@dataclass(frozen=True)
class KeyLoads:
    """Heavy keys, and the number of parts of those that are split."""

    heavy: tuple = ()
    split: Mapping = field(default_factory=dict)

    @property
    def keys(self) -> list:
        return [*self.heavy, *self.split]


def key_loads(df: DataFrame, key: str, policy: SkewPolicy) -> KeyLoads:
    """The heavy keys of a table and those to split, as Python values.

    Small tables have none and cost a count, which parquet answers from its
    footers. For others each task keeps a mergeable frequent-items sketch of
    the key column; nothing is shuffled by key, and the sketches of many tasks
    are merged in groups before the groups are. The sketch decides only how
    rows travel, never which rows are in a result. It tracks ten times the keys
    that can be heavy, so its error stays well below ``share`` and no heavy key
    is missed.
    """
    n_rows = df.count()
    limit = max(int(n_rows * policy.share), policy.min_rows)
    if n_rows <= min(limit, policy.rows_per_task):
        return KeyLoads()
    wanted = max(policy.max_keys, policy.max_split_keys)
    tracked = max(policy.max_keys * 10, policy.max_split_keys * 2)
    merged = (
        df.select(key, F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("task_group"))
        .groupBy("task_group")
        .agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("sketch"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    )
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {wanted})")).first()[0]
    found = {t["item"]: t["count"] for t in top if t["item"] is not None}
    heavy = tuple(k for k, n in found.items() if n > limit)
    parts = {k: -(-n // policy.rows_per_task) for k, n in found.items() if policy.rows_per_task < n <= limit}
    return KeyLoads(heavy, dict(list(parts.items())[: policy.max_split_keys]))


def heavy_keys(df: DataFrame, key: str, policy: SkewPolicy) -> list:
    """The heavy keys of a table, at most ``policy.max_keys``."""
    return list(key_loads(df, key, policy).heavy)


def join_one_per_key(
    many: DataFrame,
    one: DataFrame,
    key: str,
    loads: KeyLoads | Sequence,
    keep_all_of: str | None = None,
) -> DataFrame:
    """Join ``many`` with ``one``, which holds at most one row per key.

    ``keep_all_of``: ``None`` (inner), ``"many"`` or ``"one"`` (outer on that
    side). ``loads`` tells the keys with many rows in ``many`` (or lists the heavy
    ones); all of them occur there.
    """
    loads = loads if isinstance(loads, KeyLoads) else KeyLoads(tuple(loads))
    if keep_all_of == "many":
        # Rows without a key find nothing: they stay where they are, however many there are.
        found = [f for f in one.schema if f.name != key]
        no_key = many.where(F.col(key).isNull()).select(
            "*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in found)
        )
        many = many.where(F.col(key).isNotNull())
        return _joined(many, one, key, loads, keep_all_of).unionByName(no_key)
    return _joined(many, one, key, loads, keep_all_of)


def _joined(
    many: DataFrame, one: DataFrame, key: str, loads: KeyLoads, keep_all_of: str | None
) -> DataFrame:
    if not loads.heavy:
        return _dealt(many, one, key, loads.split, keep_all_of)
    is_heavy = F.coalesce(F.col(key).isin(list(loads.heavy)), F.lit(False))
    light = _dealt(many.where(~is_heavy), one.where(~is_heavy), key, loads.split, keep_all_of)
    how = "left" if keep_all_of == "many" else "inner"
    # At most len(heavy) rows: bounded by the policy.
    spread = many.where(is_heavy).join(F.broadcast(one.where(is_heavy)), key, how)
    return light.unionByName(spread)


def _dealt(
    many: DataFrame, one: DataFrame, key: str, split: Mapping, keep_all_of: str | None
) -> DataFrame:
    """The join by (key, part): rows of a split key go to its parts, ``one`` has a copy in each."""
    if not split:
        return _plain(many, one, key, keep_all_of)
    schema = T.StructType([T.StructField(key, many.schema[key].dataType), T.StructField("_parts", T.IntegerType())])
    # At most max_split_keys rows.
    parts = F.broadcast(many.sparkSession.createDataFrame(list(split.items()), schema))
    rows = [c for c in many.columns if c != key]
    # The part follows from the row, so that a task that is run again deals the same.
    part = F.pmod(F.xxhash64(*rows), F.coalesce("_parts", F.lit(1))).cast("int")
    last = F.coalesce("_parts", F.lit(1)) - 1

    def by_part(m: DataFrame, o: DataFrame, how: str) -> DataFrame:
        left = m.withColumn("_part", part).drop("_parts")
        right = o.withColumn("_part", F.explode(F.sequence(F.lit(0), last))).drop("_parts")
        return left.join(right, [key, "_part"], how).drop("_part")

    if keep_all_of == "one":
        # A copy without rows in its part is no row without a match: split keys are joined alone.
        rest = _plain(many.join(parts, key, "left_anti"), one.join(parts, key, "left_anti"), key, "one")
        return rest.unionByName(by_part(many.join(parts, key), one.join(parts, key), "inner"))
    how = "left" if keep_all_of == "many" else "inner"
    return by_part(many.join(parts, key, "left"), one.join(parts, key, "left"), how)


def _plain(many: DataFrame, one: DataFrame, key: str, keep_all_of: str | None) -> DataFrame:
    if keep_all_of == "one":
        return one.join(many, key, "left")
    return many.join(one, key, "left" if keep_all_of == "many" else "inner")
