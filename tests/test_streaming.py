"""Event ingest and refinement: restarts, repeats, faulty messages."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderloom.plans.runs import Lakehouse, run_incremental
from orderloom.sinks.events import to_events
from orderloom.sinks.tables import publish_managed, table_location
from orderloom.sources.events import PAYLOAD_SCHEMA, file_events
from orderloom.streaming import ingest, progress, publish, refine

c = F.col


def message(order_id, **changes):
    fields = {
        "order_id": order_id,
        "customer_id": " acme ",
        "employee_id": 3,
        "order_date": "2024-01-05",
        "required_date": "2024-01-05",
        "shipped_date": "2024-01-05",
        "shipper_id": 1,
        "freight": 12.5,
    }
    return json.dumps(fields | changes)


class Feed:
    """A folder that messages arrive in, and a lakehouse that ingests them."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.arrivals = f"{folder}/arrivals"
        self.lake = Lakehouse(f"{folder}/lake", f"feed_{folder.name.replace('-', '_')}")

    def arrive(self, *messages):
        rows = [(m.encode() if m is not None else None,) for m in messages]
        self.spark.createDataFrame(rows, PAYLOAD_SCHEMA).coalesce(1).write.mode("append").parquet(
            self.arrivals
        )

    def ingest(self):
        events = file_events(self.spark, self.arrivals, {"maxFilesPerTrigger": "1"})
        ingest.start_ingest(
            events, self.lake.stream("bronze"), self.lake.checkpoint("ingest")
        ).awaitTermination()

    def refine(self):
        refine.start_refine(
            self.spark,
            self.lake.stream("bronze"),
            self.lake.stream("silver"),
            self.lake.checkpoint("refine"),
        ).awaitTermination()

    def accepted(self):
        return ingest.accepted_orders(self.spark, self.lake.stream("bronze"))

    def rejected(self):
        rows = ingest.rejected_events(self.spark, self.lake.stream("bronze")).collect()
        return sorted((r["payload"] for r in rows), key=str)

    def refined(self):
        return refine.refined_orders(self.spark, self.lake.stream("silver"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def ids(df):
    return sorted(r["order_id"] for r in df.select("order_id").collect())


def test_orders_are_typed_and_classified(feed):
    feed.arrive(
        message(1),
        message(2, shipped_date="2024-01-06"),
        message(3, shipped_date=None),
        message(4, required_date="soon"),
        message(5, extra="ignored"),
    )
    feed.ingest()
    rows = {r["order_id"]: r for r in feed.accepted().collect()}
    status = {i: r["delivery_status"] for i, r in rows.items()}
    assert status == {1: "ON_TIME", 2: "DELAYED", 3: "PENDING", 4: "DELAYED", 5: "ON_TIME"}
    assert dict(feed.accepted().dtypes)["order_date"] == "date"
    assert rows[4]["required_date"] is None
    assert all(r["ingestion_timestamp"] is not None for r in rows.values())
    assert feed.rejected() == []


def test_faulty_messages_are_set_aside_with_their_payload(feed):
    faulty = ["not json", '{"order_id":"7"}', "{}", '{"order_id":null}', None]
    feed.arrive(message(1), *faulty)
    feed.ingest()
    assert ids(feed.accepted()) == [1]
    assert feed.rejected() == sorted(faulty, key=str)


@pytest.mark.parametrize(
    ("field", "value"),
    [
        ("customer_id", {"a": 1}),
        ("employee_id", "three"),
        ("order_date", [1]),
        ("shipper_id", "x"),
        ("freight", "12.5"),
    ],
)
def test_an_order_with_an_unreadable_field_is_kept(feed, field, value):
    sent = message(7, **{field: value})
    feed.arrive(sent, message(8))
    feed.ingest()
    rows = {r["order_id"]: r for r in feed.accepted().collect()}
    assert set(rows) == {7, 8}
    kept = {"customer_id": " acme ", "employee_id": 3, "shipper_id": 1, "freight": 12.5}
    assert {k: rows[8][k] for k in kept} == kept
    # A text field takes what is sent as text; any other is empty.
    assert all(rows[7][k] == v for k, v in kept.items() if k != field)
    if field not in ("customer_id", "order_date"):
        assert rows[7][field] is None
        partly = ingest.partly_read_events(feed.spark, feed.lake.stream("bronze")).collect()
        assert [(r["order_id"], r["payload"]) for r in partly] == [(7, sent)]
    assert feed.rejected() == []


def test_files_are_read_however_old(feed):
    for i in range(4):
        feed.arrive(message(i + 1))
        if i == 2:
            (newest,) = sorted(Path(feed.arrivals).glob("*.parquet"), key=lambda p: p.stat().st_mtime)[-1:]
            month_ago = time.time() - 30 * 24 * 3600
            os.utime(newest, (month_ago, month_ago))
        feed.ingest()
    assert ids(feed.accepted()) == [1, 2, 3, 4]
    feed.refine()
    assert ids(feed.refined()) == [1, 2, 3, 4]


def test_state_partitions_do_not_follow_the_batch_width(feed):
    feed.arrive(message(1), message(2))
    feed.ingest()
    spark = feed.spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    args = (spark, feed.lake.stream("bronze"), feed.lake.stream("silver"), feed.lake.checkpoint("refine"))
    refine.start_refine(*args, state_partitions=3, thin_repeats=True).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = Path(feed.lake.checkpoint("refine")) / "state" / "0"
    assert len([p for p in state.iterdir() if p.name.isdigit()]) == 3
    assert ids(feed.refined()) == [1, 2]


def test_publication_adds_only_what_is_new(feed):
    spark, table = feed.spark, feed.lake.stream_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {feed.lake.database}")
    feed.arrive(message(1), message(2))
    feed.ingest()
    feed.refine()
    assert publish.publish_orders(spark, feed.lake.stream("silver"), table) == 2
    files = set(spark.table(table).inputFiles())
    assert publish.publish_orders(spark, feed.lake.stream("silver"), table) == 2
    feed.arrive(message(2), message(3))
    feed.ingest()
    feed.refine()
    assert publish.publish_orders(spark, feed.lake.stream("silver"), table) == 3
    # What was there stays as it is.
    assert files <= set(spark.table(table).inputFiles())
    assert ids(spark.table(table)) == [1, 2, 3]
    assert publish.publish_orders(spark, feed.lake.stream("silver"), table, rebuild=True) == 3
    spark.sql(f"DROP DATABASE {feed.lake.database} CASCADE")


def test_publication_does_not_trust_clocks(feed, monkeypatch):
    """A restarted driver whose clock is a day behind stamps its rows before all published ones."""
    spark, table = feed.spark, feed.lake.stream_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {feed.lake.database}")
    feed.arrive(message(1), message(2))
    feed.ingest()
    feed.refine()
    assert publish.publish_orders(spark, feed.lake.stream("silver"), table) == 2
    yesterday = F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    monkeypatch.setattr(refine.F, "current_timestamp", lambda: yesterday)
    for i in (3, 4):
        feed.arrive(message(i))
        feed.ingest()
        feed.refine()
        assert publish.publish_orders(spark, feed.lake.stream("silver"), table) == i
    stamps = [r["silver_load_timestamp"] for r in spark.table(table).orderBy("order_id").collect()]
    assert max(stamps[2:]) < min(stamps[:2])
    spark.sql(f"DROP DATABASE {feed.lake.database} CASCADE")


def test_publication_ends_what_a_failed_one_began(feed):
    """Files of an attempt that was not committed are no rows, and its orders come once."""
    spark, table, silver = feed.spark, feed.lake.stream_table, feed.lake.stream("silver")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {feed.lake.database}")
    feed.arrive(message(1))
    feed.ingest()
    feed.refine()
    progress = feed.lake.checkpoint("publish")
    assert publish.publish_orders(spark, silver, table, progress=progress) == 1
    feed.arrive(message(2))
    feed.ingest()
    feed.refine()
    assert publish.publish_orders(spark, silver, table, progress=progress) == 2
    # As after a crash between the files of the second batch and the commits of it.
    folder = Path(table_location(spark, table).removeprefix("file:"))
    (checkpoint,) = Path(progress).iterdir()
    for log in (folder / "_spark_metadata", checkpoint / "commits"):
        (log / "1").unlink()
        (log / ".1.crc").unlink()
    spark.catalog.refreshTable(table)
    assert ids(spark.table(table)) == [1]
    assert publish.publish_orders(spark, silver, table, progress=progress) == 2
    assert ids(spark.table(table)) == [1, 2]
    # A table that was made elsewhere is filled from the start.
    spark.sql(f"DROP TABLE {table}")
    publish_managed(feed.refined().limit(1), table)
    assert publish.publish_orders(spark, silver, table, progress=progress) == 2
    spark.sql(f"DROP DATABASE {feed.lake.database} CASCADE")


def test_every_message_is_landed_once(feed):
    """Read without regard to acceptance, a faulty message is an empty pending order."""
    feed.arrive(message(1), "not json")
    feed.ingest()
    landed = ingest.landed_rows(feed.spark, feed.lake.stream("bronze"))
    assert landed.count() == 2
    empty = landed.where(c("order_id").isNull()).first()
    assert (empty["delivery_status"], empty["freight"]) == ("PENDING", None)


def test_a_restart_adds_only_what_is_new(feed):
    feed.arrive(message(1), message(2))
    feed.ingest()
    feed.ingest()
    assert ids(feed.accepted()) == [1, 2]
    feed.arrive(message(3))
    feed.ingest()
    assert ids(feed.accepted()) == [1, 2, 3]


def test_repeats_collapse_within_and_across_batches_and_restarts(feed):
    feed.arrive(message(1), message(1), message(2))
    feed.arrive(message(2), message(3))
    feed.ingest()
    feed.refine()
    assert ids(feed.refined()) == [1, 2, 3]
    feed.refine()
    assert ids(feed.refined()) == [1, 2, 3]
    feed.arrive(message(3), message(4))
    feed.ingest()
    feed.refine()
    assert ids(feed.refined()) == [1, 2, 3, 4]
    row = feed.refined().first()
    assert row["customer_id"] == "ACME"
    assert row["silver_load_timestamp"] is not None


def test_settings_are_put_back(feed):
    name = next(iter(refine.STATE_SETTINGS))
    before = feed.spark.conf.get(name, None)
    feed.arrive(message(1))
    feed.ingest()
    feed.refine()
    assert feed.spark.conf.get(name, None) == before


def test_repeats_within_an_arrow_batch():
    def batch(keys):
        return pa.RecordBatch.from_pydict({"order_id": keys, "v": list(range(len(keys)))})

    keep_first = refine.first_rows_of_batches("order_id")
    thinned = keep_first(iter([batch([1, 1, 2, None, None, 1]), batch([1])]))
    assert [b.to_pydict() for b in thinned] == [
        {"order_id": [1, 2, None], "v": [0, 2, 3]},
        {"order_id": [1], "v": [0]},
    ]
    # Beyond 2 ** 53 neighbours differ only as integers.
    big = [2**53, 2**53 + 1, None, 2**53]
    assert [b.to_pydict()["order_id"] for b in keep_first(iter([batch(big)]))] == [big[:3]]


def test_incremental_run_is_repeatable(feed):
    feed.arrive(message(1), message(1), "bad", message(25))
    for _ in range(2):
        events = file_events(feed.spark, feed.arrivals)
        assert run_incremental(feed.spark, events, feed.lake) == 2
    feed.arrive(*(message(i) for i in range(2, 30)))
    assert run_incremental(feed.spark, file_events(feed.spark, feed.arrivals), feed.lake) == 29
    newest = publish.latest_orders(feed.spark, feed.lake.stream_table)
    assert [r["order_id"] for r in newest.collect()] == list(range(29, 9, -1))
    feed.spark.sql(f"DROP DATABASE {feed.lake.database} CASCADE")


def test_events_keep_nulls_and_microseconds(spark):
    df = spark.sql(
        "SELECT 1 AS order_id, CAST(NULL AS STRING) AS shipped_date, "
        "TIMESTAMP_NTZ '2024-01-05 10:00:00.123456' AS ts"
    )
    value = to_events(df).first()["value"]
    assert json.loads(bytes(value)) == {
        "order_id": 1,
        "shipped_date": None,
        "ts": "2024-01-05T10:00:00.123456",
    }


def test_ingest_with_an_interval_keeps_running(feed):
    feed.arrive(message(1))
    query = ingest.start_ingest(
        file_events(feed.spark, feed.arrivals),
        feed.lake.stream("bronze"),
        feed.lake.checkpoint("ingest"),
        interval="1 second",
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert ids(feed.accepted()) == [1]


def test_an_idle_interval_run_ends_and_tells_its_counts(feed):
    """Counts come with the batches: no job runs after the last of them."""
    feed.arrive(message(1), message(2), "no json")
    query = ingest.start_ingest(
        file_events(feed.spark, feed.arrivals),
        feed.lake.stream("bronze"),
        feed.lake.checkpoint("ingest"),
        interval="1 second",
    )
    found = []
    for batch in progress.batches(query, idle_seconds=4):
        found.append(batch)
        if len(found) == 1:
            feed.arrive(message(2), message(3))
    assert not query.isActive
    assert [b.counts for b in found] == [
        {"rows": 3, "accepted": 2, "rejected": 1},
        {"rows": 2, "accepted": 2, "rejected": 0},
    ]
    assert [b.batch_id for b in found] == [0, 1]
    assert all(0 <= b.lag < 120 for b in found)
    query = refine.start_refine(
        feed.spark, feed.lake.stream("bronze"), feed.lake.stream("silver"), feed.lake.checkpoint("refine")
    )
    assert sum(b.counts["rows"] for b in progress.batches(query)) == 3
    # The same checkpoint again: nothing is left to read.
    query = refine.start_refine(
        feed.spark, feed.lake.stream("bronze"), feed.lake.stream("silver"), feed.lake.checkpoint("refine")
    )
    assert list(progress.batches(query)) == []


def test_an_interval_run_without_data_ends_and_failures_are_raised(feed):
    feed.arrive(message(1))
    feed.ingest()
    query = ingest.start_ingest(
        file_events(feed.spark, feed.arrivals),
        feed.lake.stream("bronze"),
        feed.lake.checkpoint("ingest"),
        interval="1 second",
    )
    assert list(progress.batches(query, idle_seconds=2)) == []
    assert not query.isActive
    events = file_events(feed.spark, feed.arrivals)
    broken = events.withColumn("value", F.raise_error(F.lit("broken")).cast("binary"))
    query = ingest.start_ingest(broken, feed.lake.stream("other"), feed.lake.checkpoint("other"), interval="1 second")
    with pytest.raises(StreamingQueryException):
        list(progress.batches(query, idle_seconds=30))
