"""Landing table to one row per order, across runs and restarts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions import upper_trimmed
from orderloom.sources.events import NO_FILE_TOO_OLD
from orderloom.streaming.ingest import landing_schema
from orderloom.streaming.progress import counted

Batches = Iterator[pa.RecordBatch]

c = F.col

KEY = "order_id"

# The state of the deduplication is all order ids seen so far: on disk, not on the heap.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_WIDTH = "spark.sql.shuffle.partitions"
MAX_STATE_PARTITIONS = 256


def landed_stream(
    spark: SparkSession,
    landing: str,
    key_type: str = "int",
    batch_limits: Mapping[str, str] | None = None,
) -> DataFrame:
    """Accepted orders of the landing table, each once, as they arrive.

    ``batch_limits``: ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``, so that a
    large backlog is worked off in batches of a size the cluster is made for.
    """
    return (
        spark.readStream.schema(landing_schema(key_type))
        .options(**NO_FILE_TOO_OLD)
        .options(**(batch_limits or {}))
        .parquet(landing)
        .where(c("accepted"))
        .drop("accepted", "payload")
    )


def refine_orders(orders: DataFrame, thin_repeats: bool = False) -> DataFrame:
    """Customer code normalised, load stamped, one row per order id kept.

    Which of several rows survives is open, as rows of a stream have no order.
    ``thin_repeats`` sends rows through an Arrow filter first, for streams in
    which single ids are repeated very often.
    """
    cleaned = orders.withColumn("customer_id", upper_trimmed(c("customer_id")))
    if thin_repeats:
        cleaned = cleaned.mapInArrow(first_rows_of_batches(KEY), cleaned.schema)
    return cleaned.dropDuplicates([KEY]).withColumn(
        "silver_load_timestamp", F.current_timestamp()
    )


def first_rows_of_batches(key: str) -> Callable[[Batches], Batches]:
    """Filter that keeps the first row per key within each Arrow batch.

    The stateful distinct sends all rows of a key to one task and has no
    pre-aggregation of its own. This keeps an id that is repeated very often
    from flooding that task: one row per batch of thousands goes on. A closure,
    so that it travels to the workers by value.
    """

    def keep_first(batches: Batches) -> Batches:
        for batch in batches:
            # Keys stay what they are: no detour by way of floating point.
            codes = batch.column(key).dictionary_encode(null_encoding="encode").indices
            _, first = np.unique(codes.to_numpy(zero_copy_only=False), return_index=True)
            yield batch.take(pa.array(np.sort(first)))

    return keep_first


def refined_schema(key_type: str = "int") -> T.StructType:
    columns = [f for f in landing_schema(key_type) if f.name not in ("accepted", "payload")]
    return T.StructType([*columns, T.StructField("silver_load_timestamp", T.TimestampType())])


def start_refine(
    spark: SparkSession,
    landing: str,
    refined: str,
    checkpoint: str,
    interval: str | None = None,
    key_type: str = "int",
    batch_limits: Mapping[str, str] | None = None,
    state_partitions: int | None = None,
    thin_repeats: bool = False,
) -> StreamingQuery:
    """Start the refinement: what is available and stop, or every ``interval``.

    The state lives in the checkpoint: a later start with the same checkpoint
    adds only orders that were never seen. The first start fixes the number of
    ``state_partitions``, which is also the number of tasks and files of every
    micro-batch: choose it by what a batch and the ids of all time need, not by
    the width of batch shuffles. By default it is that width, at most
    MAX_STATE_PARTITIONS. Orders are counted per batch, see ``progress.batches``.
    """
    landed = landed_stream(spark, landing, key_type, batch_limits)
    stream = counted(refine_orders(landed, thin_repeats), "ingestion_timestamp")
    width = int(spark.conf.get(_WIDTH))
    settings = STATE_SETTINGS | {_WIDTH: str(state_partitions or min(width, MAX_STATE_PARTITIONS))}
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", refined)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with _settings(spark, settings):
        return writer.trigger(**trigger).start()


def refined_orders(spark: SparkSession, refined: str, key_type: str = "int") -> DataFrame:
    return spark.read.schema(refined_schema(key_type)).parquet(refined)


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """A query takes a copy of the session's settings when it starts; they are put back after."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
