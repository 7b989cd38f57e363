"""Joins and filters for tables whose keys may be as uneven as copies of documents are."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with more than this share of all rows is joined by broadcast; there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
#: Rows of a small table that may be broadcast.
SMALL_ROWS = 50_000


def attach(
    many: DataFrame,
    one: DataFrame,
    key: Sequence[str],
    n: str,
    total: int,
    how: str = "inner",
    may_broadcast: Column | None = None,
) -> DataFrame:
    """Join ``many`` with ``one``, which has a row per key and the key's rows in ``many`` as ``n``.

    ``how``: "inner" or "left". Keys with more than HOT_SHARE of ``total``, the
    number of rows of ``many``, are fewer than 1 / HOT_SHARE, so their rows of
    ``one`` are broadcast (those for which ``may_broadcast`` holds) and the rows
    of ``many`` stay where they are. All others are joined by a shuffle in which
    no key is large, or which Spark can split.
    """
    key = list(key)
    hot = F.col(n) > max(1, int(total * HOT_SHARE))
    if may_broadcast is not None:
        hot &= may_broadcast
    few = F.broadcast(one.where(hot))
    rest = many.join(few.select(*key), key, "left_anti").join(one.where(~hot), key, how)
    return many.join(few, key).unionByName(rest)


class KeyFilter:
    """A bitmap over 64-bit keys: no key of the table is missed, some others pass.

    It thins out rows before an exact join. Its size follows the number of keys
    up to a bound: MOST_BITS make 256 MB, whatever the number of keys; beyond
    about as many keys as bits it lets most rows pass.
    """

    LEAST_BITS, MOST_BITS = 20, 31

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = len(words) * 64 - 1

    @classmethod
    def of(cls, keys: DataFrame, key: str, n: int | None = None, most_bits: int = MOST_BITS) -> KeyFilter:
        """Of column ``key``; ``n``: its number of rows, if that is known."""
        n = keys.count() if n is None else n
        bits = min(most_bits, max(cls.LEAST_BITS, (12 * n).bit_length()))
        place = F.expr(f"{key} & {(1 << bits) - 1}")
        found = (
            keys.select(place.alias("place"))
            .select(F.shiftright("place", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .toArrow()  # at most 2 ** (MOST_BITS - 6) rows
        )
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return cls(words)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        place = keys.astype(np.uint64) & np.uint64(self.mask)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of ``counts`` with the largest ``n``, at most ``limit``; of one ``n`` all or none.

    The smallest n that still fits is found among the different values of n, of
    which there are few, so no task sorts or receives the rows themselves.
    """
    values = counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.orderBy(F.desc("n")))
    least = values.select("n", upto.alias("upto")).where(F.col("upto") <= limit).agg(F.min("n")).first()[0]
    return counts.where(F.lit(False)) if least is None else counts.where(F.col("n") >= least)


def small_or_shuffled(table: DataFrame, n_rows: int) -> DataFrame:
    """``table`` with a broadcast hint if it is small."""
    return F.broadcast(table) if n_rows <= SMALL_ROWS else table


def unit(key: Column) -> Column:
    """A number between 0 and 1 (exclusive) that depends on the key alone."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
