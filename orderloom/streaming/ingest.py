"""Order events to a parquet landing table.

Every message becomes one row. A message with an order id is an order, whatever
else it holds: a field that cannot be read is NULL. All others (not JSON, no
usable id) are kept in partition ``accepted=false``: one stream, one exactly-once
sink, and nothing is lost or read twice. The payload is kept wherever something
could not be read. ``accepted_orders`` and ``rejected_events`` read the two
parts, and both prune to their partition; ``partly_read_events`` reads the
payloads of orders with unreadable fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom import functions as fn
from orderloom.schemas import event_schema
from orderloom.streaming.progress import counted

c = F.col

_DATES = ("order_date", "required_date", "shipped_date")
_ACCEPTED = "accepted"
_BAD = "_unparsed"


def decode_payload(events: DataFrame, key_type: str = "int") -> DataFrame:
    """JSON payloads to columns; ``payload`` is kept where it could not be read."""
    schema = event_schema(key_type).add(_BAD, T.StringType())
    text = c("value").cast("string")
    order = F.from_json(text, schema, {"columnNameOfCorruptRecord": _BAD})
    columns = event_schema(key_type).names
    parsed = events.select(text.alias("payload"), order.alias("order")).select("payload", "order.*")
    usable = c("order_id").isNotNull()
    return parsed.select(
        *columns,
        F.when(c(_BAD).isNotNull() | ~usable, c("payload")).alias("payload"),
        usable.alias(_ACCEPTED),
    )


def classify_orders(decoded: DataFrame) -> DataFrame:
    """Dates typed, delivery classified, arrival stamped."""
    return decoded.withColumns({name: fn.to_iso_date(c(name)) for name in _DATES}).withColumns(
        {
            "delivery_status": fn.delivery_status(c("shipped_date"), c("required_date")),
            "ingestion_timestamp": F.current_timestamp(),
        }
    )


def landing_schema(key_type: str = "int") -> T.StructType:
    """Columns of the landing table, for streams that read it."""
    columns = [
        T.StructField(f.name, T.DateType() if f.name in _DATES else f.dataType)
        for f in event_schema(key_type)
    ]
    return T.StructType(
        [
            *columns,
            T.StructField("payload", T.StringType()),
            T.StructField("delivery_status", T.StringType()),
            T.StructField("ingestion_timestamp", T.TimestampType()),
            T.StructField(_ACCEPTED, T.BooleanType()),
        ]
    )


def start_ingest(
    events: DataFrame,
    landing: str,
    checkpoint: str,
    interval: str | None = None,
    key_type: str = "int",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the ingest: all available events and stop, or every ``interval``.

    ``files_per_batch`` bounds the files that a micro-batch adds per partition:
    with a short interval, set it to what an interval's events fill. Accepted and
    rejected events are counted per batch, see ``progress.batches``.
    """
    rows = classify_orders(decode_payload(events, key_type))
    rows = counted(rows, "ingestion_timestamp", accepted=c(_ACCEPTED), rejected=~c(_ACCEPTED))
    if files_per_batch:
        rows = rows.coalesce(files_per_batch)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(_ACCEPTED)
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def landed_rows(spark: SparkSession, landing: str, key_type: str = "int") -> DataFrame:
    """Every message as one row, malformed ones as NULL columns and PENDING."""
    return spark.read.schema(landing_schema(key_type)).parquet(landing)


def accepted_orders(spark: SparkSession, landing: str, key_type: str = "int") -> DataFrame:
    return landed_rows(spark, landing, key_type).where(c(_ACCEPTED)).drop(_ACCEPTED, "payload")


def partly_read_events(spark: SparkSession, landing: str, key_type: str = "int") -> DataFrame:
    """Orders that are in use although some of their fields could not be read."""
    return (
        landed_rows(spark, landing, key_type)
        .where(c(_ACCEPTED) & c("payload").isNotNull())
        .select("order_id", "payload", "ingestion_timestamp")
    )


def rejected_events(spark: SparkSession, landing: str, key_type: str = "int") -> DataFrame:
    return (
        landed_rows(spark, landing, key_type)
        .where(~c(_ACCEPTED))
        .select("payload", "ingestion_timestamp")
    )
