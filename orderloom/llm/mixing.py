"""Sources mixed to target weights by weighted sampling without replacement.

A document's key is exponential: -ln(u) / weight, with u from its doc_id and the
weight from its quality. The smallest keys of a source are a weighted sample of
it without replacement. A target beyond a source's size first takes the whole
source, once or more (complete epochs); the rest is taken in key order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import SPACED, Texts, map_texts, sums
from orderloom.llm.spread import SMALL_ROWS, attach, small_or_shuffled, unit
from orderloom.scratch import new_scratch, written

#: Documents of a source that are sorted together; more are first narrowed down.
RANGE_ROWS = 4_000
#: Keys are narrowed down by digits of so many bits, of so many bits in all.
_DIGIT, _BITS = 12, 48
#: Least quality weight of a document.
LEAST_WEIGHT = 1e-3
_WEIGHT = "_quality_weight"

_CLEAN = np.zeros(256, np.int64)
_CLEAN[[*range(9, 14), 32, *range(48, 58), *range(65, 91), *range(97, 123), *range(0xC0, 256)]] = 1
_CHARS = np.ones(256, np.int64)
_CHARS[0x80:0xC0] = 0  # later bytes of a character


def sized(documents: DataFrame, keep: Sequence[str] = ("doc_id", "source"), quality: str | None = None) -> DataFrame:
    """Columns ``keep`` with ``size``, the number of words, and ``weight``, the quality weight.

    The weight is column ``quality``, at least LEAST_WEIGHT, if there is one, else
    the share of characters that are letters, digits, white space or beyond
    ASCII, each count plus one. Null or empty text: size 0, weight 1.
    """

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = Texts.of(batch.column("text"))
        clean, chars = sums(_CLEAN[texts.data], texts.at), sums(_CHARS[texts.data], texts.at)
        return [pa.array(texts.words(SPACED).counts), pa.array((clean + 1.0) / (chars + 1.0))]

    if quality is None:
        return map_texts(documents, work, "size bigint, weight double", keep)
    given = F.col(quality).cast("double")
    weight = F.when(given >= LEAST_WEIGHT, F.when(~F.isnan(given), given)).otherwise(LEAST_WEIGHT)
    with_weight = documents.withColumn(_WEIGHT, F.coalesce(weight, F.lit(LEAST_WEIGHT)))
    found = map_texts(with_weight, work, "size bigint, weight double", [*keep, _WEIGHT])
    return found.drop("weight").withColumnRenamed(_WEIGHT, "weight").select(*keep, "size", "weight")


def source_targets(totals: DataFrame, weights: Sequence[int], budget: float, epochs: float) -> DataFrame:
    """Targets of the sources of ``totals`` (source, source_size, n).

    Sources take ``weights`` in turn by code point of their names, null last.
    They share ``budget`` times all sizes by weight; one that would get more than
    ``epochs`` times its size gets that, and the others share what it leaves.
    So every target is min(epochs * size, level * weight) with one level for all:
    sources in the order of the level at which they are full are full up to the
    first whose level is not reached. One row per source is sorted here, never
    documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turns = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.select(
        "*", F.get(turns, (F.row_number().over(by_name) - 1) % len(weights)).alias("turn")
    ).withColumn("full_at", epochs * F.col("source_size") / F.col("turn"))
    everything = Window.partitionBy()
    before = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        (budget * F.sum("source_size").over(everything) - epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        (F.sum("turn").over(everything) - F.coalesce(F.sum("turn").over(before), F.lit(0.0))).alias("turns_left"),
    )
    open_ = F.col("left") / F.col("turns_left") < F.col("full_at")
    level = F.first(F.when(open_, F.col("left") / F.col("turns_left")), ignorenulls=True).over(
        Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.select("*", level.alias("level")).select(
        "source",
        "source_size",
        "n",
        F.when(F.col("level").isNull() | (F.col("full_at") <= F.col("level")), epochs * F.col("source_size"))
        .otherwise(F.col("level") * F.col("turn"))
        .alias("target"),
    )


def _key():
    return -F.log(unit(F.col("doc_id"))) / F.col("weight")


def _place(key):
    """A whole number of _BITS bits that never falls where the key rises."""
    return F.least(F.floor(key / (1 + key) * float(1 << _BITS)), F.lit((1 << _BITS) - 1)).cast("long")


def cutoffs(sizes: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """Per source: complete ``epochs`` and the last key and doc_id that the fraction takes (null: none).

    Keys in order are prefix-summed to the budget in rounds. A round sums the
    sizes by the next digit of the keys' place and keeps the digit in which the
    budget ends, until each source has at most RANGE_ROWS rows left; those are
    sorted. So no source, however large, is sorted in one task or shuffled, and
    how weights and keys are distributed does not matter: only rows whose keys
    agree in all _BITS bits stay together, and rows of one key and doc_id are
    one row. The document at the edge of the budget is taken if more than half
    of it fits. Rows with one doc_id and weight are taken together.
    """
    spark = sizes.sparkSession
    scratch = new_scratch(spark, "cutoffs")
    name = ["name", "no_name"]
    targets = targets.select(
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("no_name"),
        "n",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
        F.when(F.col("source_size") > 0, F.col("target") - F.col("source_size") * F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0.0)
        .alias("rest"),
    )
    key = _key()
    keyed = sizes.select(
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("no_name"),
        F.struct(key.alias("key"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id")).alias("at"),
        "size",
        _place(key).alias("place"),
    )
    # Where each source's budget ends: the first digits, words before them, the last row before them, rows in them.
    ends = targets.select(
        *name, "rest", F.lit(0).cast("long").alias("digits"), F.lit(0).cast("long").alias("before"),
        F.lit(None).cast(keyed.schema["at"].dataType).alias("last"), F.col("n").alias("rows"),
    )
    shift = _BITS
    earlier = Window.partitionBy(*name).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)

    def inside():
        mine = F.shiftright("place", shift) == F.col("digits") if shift < _BITS else F.lit(True)
        return keyed.join(small_or_shuffled(ends, n_sources), name).where(mine)

    while shift and (ends.agg(F.max("rows")).first()[0] or 0) > RANGE_ROWS:
        found = inside()
        shift -= _DIGIT
        # At most 2 ** _DIGIT rows per source leave a task.
        sums_of = found.groupBy(*name, F.shiftright("place", shift).alias("digit")).agg(
            F.first("rest").alias("rest"),
            F.first("before").alias("before"),
            F.first("last").alias("last"),
            F.sum("size").alias("digit_size"),
            F.max("at").alias("digit_last"),
            F.count(F.lit(1)).alias("rows"),
        )
        ends = (
            sums_of.select(
                *name,
                "rest",
                "digit",
                (F.col("before") + F.coalesce(F.sum("digit_size").over(earlier), F.lit(0))).alias("before"),
                F.coalesce(F.max("digit_last").over(earlier), F.col("last")).alias("last"),
                "rows",
            )
            .where(F.col("before") <= F.col("rest"))
            .groupBy(*name)
            .agg(F.max_by(F.struct("rest", F.col("digit").alias("digits"), "before", "last", "rows"), "digit").alias("end"))
            .select(*name, "end.*")
        )
        ends = written(spark, ends, f"{scratch}/{shift}")
    rows = inside().groupBy(*name, "at", "rest", "before", "last").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy(*name).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = (
        rows.withColumn("fits", F.col("before") + upto - F.col("size") / 2 <= F.col("rest"))
        .groupBy(*name)
        .agg(F.greatest(F.max(F.when(F.col("fits"), F.col("at"))), F.first("last")).alias("last"))
    )
    return targets.join(taken, name, "left").select(*name, "epochs", "n", "last")


def mix(
    documents: DataFrame,
    keep: Sequence[str] = ("doc_id", "source"),
    weights: Sequence[int] = (5, 2, 1),
    budget: float = 1.5,
    epochs: float = 2.0,
    quality: str | None = None,
) -> DataFrame:
    """Every document with what the mix takes of it.

    ``quality``: a column of ``documents`` with their quality weights, such as the
    score of the quality classifier; null, NaN and weights below LEAST_WEIGHT
    count as LEAST_WEIGHT, so that every document can be drawn. Without it the
    share of ordinary characters is the weight (see ``sized``).

    ``keep``: columns of ``documents`` to return; ``source`` and ``doc_id`` must
    be among them. Added: ``size``, ``weight``, ``source_size``, ``target`` (of
    its source), ``copies`` and ``taken`` (words, repeats counted). Documents of
    a null source form a source. Null doc_ids share one key and are taken
    together, as are rows with one doc_id. An empty table has an empty result.
    Documents without words count nothing; they are taken with the keys around
    them and take 0 words.
    """
    spark = documents.sparkSession
    scratch = new_scratch(spark, "mixing")
    sizes = written(spark, sized(documents, quality=quality), f"{scratch}/sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = written(spark, source_targets(totals, weights, budget, epochs), f"{scratch}/targets")
    n_sources = targets.count()
    ends = cutoffs(sizes, targets, n_sources)
    plan = written(
        spark,
        targets.select(
            F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("no_name"), "source_size", "target"
        ).join(ends, ["name", "no_name"]),
        f"{scratch}/plan",
    )
    # The sizes are counted anew only where more than the two narrow columns is returned.
    source = sizes if set(keep) == {"doc_id", "source"} else sized(documents, keep, quality)
    named = source.withColumns({"name": F.coalesce("source", F.lit("")), "no_name": F.col("source").isNull()})
    if n_sources <= SMALL_ROWS:
        joined = named.join(F.broadcast(plan), ["name", "no_name"])
    else:
        joined = attach(named, plan, ["name", "no_name"], "n", sizes.count())
    in_fraction = F.col("last").isNotNull() & (F.struct(_key().alias("key"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id")) <= F.col("last"))
    copies = (F.col("epochs") + F.coalesce(in_fraction, F.lit(False)).cast("long")).alias("copies")
    return joined.select(*keep, "size", "weight", "source_size", "target", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )
