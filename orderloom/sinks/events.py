"""Rows as JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: keeps microseconds, which the default layout cuts off.
_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_events(df: DataFrame) -> DataFrame:
    """One binary ``value`` per row: its columns as a JSON object, NULLs as ``null``."""
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": _TIMESTAMP,
        "timestampNTZFormat": _TIMESTAMP,
    }
    return df.select(F.to_json(F.struct("*"), options).cast("binary").alias("value"))


def send_to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector; each task sends its own rows."""
    (
        events.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
