"""Order event streams: rows with a binary ``value`` that holds a JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

PAYLOAD_SCHEMA = "value binary"

# A file source forgets files after a week by default and then ignores every older file that
# arrives, without a word. No file is ever too old here.
NO_FILE_TOO_OLD = {"maxFileAge": "36500d"}
# Options of the Kafka source for everything a topic holds.
KAFKA_FROM_START = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_events(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """All messages of a topic, from the earliest; lost offsets do not stop the stream.

    Needs the Kafka connector of the running Spark version (``spark.jars.packages``).
    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch, ``minPartitions`` to
    read big topic partitions with several tasks.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**KAFKA_FROM_START)
        .options(**(options or {}))
        .load()
        .select("value")
    )


def file_events(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Parquet files of payloads that arrive in a directory, each once, however old.

    The names of all files seen stay in memory. Where many arrive, pass
    ``cleanSource="archive"`` and ``sourceArchiveDir``: files that have been read
    move there, and the directory to list stays short.
    """
    return (
        spark.readStream.format("parquet")
        .schema(PAYLOAD_SCHEMA)
        .options(**NO_FILE_TOO_OLD)
        .options(**(options or {}))
        .load(path)
    )
