"""Refined orders as segments of a catalog table: no state, one row per id, few files.

The stateful distinct of ``refine`` keeps the ids of all time in its state, and its
folder gathers the files of all micro-batches. Here the refined rows themselves say
which ids are known. Each run reads the landed files that no segment covers yet,
drops the ids that are refined already, and writes the others as one segment. When
``fan`` segments of a tier have come together they are folded into one of the next
tier, sorted by id: a row is rewritten once per tier, and the numbers of segments
and of files grow with the logarithm of the number of runs.

Readers use a view that names the live segments. Replacing its text is the one
step by which an append or a fold becomes visible, so readers see the segments
before or after it. What a run that failed left behind is not named by the view; the
next run reads the same landed files again, and ids of rows that are visible already
are dropped by their key. One process at a time writes to a table of segments.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.catalog import ensure_database
from orderloom.functions import upper_trimmed
from orderloom.operators.audit import counted
from orderloom.streaming.ingest import accepted_orders, landing_schema
from orderloom.streaming.refine import KEY, refined_schema

c = F.col

_ACCEPTED_FOLDER = "/accepted=true/"
_NAMED = re.compile(r"'(\d+-[0-9a-f]{32})'")
# Assumed, on the safe side: an id in a broadcast hash table, with what surrounds it.
_BYTES_PER_ID = 64


@dataclass(frozen=True)
class SegmentTable:
    """A view ``name`` (``database.view``), the table of its segments, and the folder that holds both.

    ``fan``: segments of a tier that are folded into one. ``broadcast_bytes``: the ids
    of a run are sent to all tasks up to this size, and shuffled beyond it.
    """

    name: str
    root: str
    key_type: str = "int"
    fan: int = 16
    broadcast_bytes: int = 64 * 1024 * 1024

    @property
    def parts(self) -> str:
        return f"{self.name}_segments"

    @property
    def schema(self) -> T.StructType:
        return refined_schema(self.key_type)

    def folder(self, segment: str) -> str:
        return f"{self.root.rstrip('/')}/rows/segment={segment}"

    def ledger(self, segment: str) -> str:
        """Landed files that a segment covers."""
        return f"{self.root.rstrip('/')}/sources/segment={segment}"


def ensure_segments(spark: SparkSession, table: SegmentTable) -> None:
    """Database, table and view, if they are not there yet."""
    ensure_database(spark, table.name.rsplit(".", 1)[0])
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.parts} ({columns}, segment STRING) USING parquet "
        f"PARTITIONED BY (segment) LOCATION '{table.root.rstrip('/')}/rows'"
    )
    if not spark.catalog.tableExists(table.name):
        spark.sql(f"CREATE VIEW {table.name} AS {_reading(table, [])}")


def live_segments(spark: SparkSession, table: SegmentTable) -> list[str]:
    """Segments that the view names, as ``<tier>-<id>``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").where("col_name = 'View Text'")
    return _NAMED.findall(described.first()["data_type"])


def covered_files(spark: SparkSession, table: SegmentTable) -> DataFrame:
    """Landed files whose rows the live segments account for."""
    ledgers = [table.ledger(s) for s in live_segments(spark, table)]
    if not ledgers:
        return spark.createDataFrame([], "file string")
    return spark.read.schema("file string").parquet(*ledgers)


def refine_new(
    spark: SparkSession, landing: str, table: SegmentTable, max_files: int = 10_000
) -> int:
    """Refine what has landed since the last run; returns the number of new orders.

    A backlog is worked off by ``max_files`` landed files at a time, each lot a
    segment. Which of several rows with one id survives is open.
    """
    ensure_segments(spark, table)
    added = 0
    files = _new_files(spark, landing, table)
    for first in range(0, len(files), max_files):
        lot = files[first : first + max_files]
        added += _append(spark, landing, table, lot)
        fold_segments(spark, table)
    return added


def fold_segments(spark: SparkSession, table: SegmentTable) -> int:
    """Fold full tiers, lowest first; returns how many segments were folded.

    Folded segments stay on disk until the next fold, for those who are reading them.
    """
    folded = 0
    while full := _full_tier(live_segments(spark, table), table.fan):
        live = live_segments(spark, table)
        tier = int(full[0].split("-")[0])
        segment = _name(tier + 1)
        rows = spark.table(table.parts).where(c("segment").isin(full)).select(*table.schema.names)
        # Ids occur once, so ranges of ids are even.
        by_id = rows.repartitionByRange(KEY).sortWithinPartitions(KEY)
        sources = spark.read.schema("file string").parquet(*(table.ledger(s) for s in full))
        _write(spark, table, segment, by_id, sources.coalesce(1))
        _show(spark, table, [s for s in live if s not in full] + [segment])
        _sweep(spark, table, keep=full)
        folded += len(full)
    return folded


def known_ids(spark: SparkSession, table: SegmentTable, ids: DataFrame) -> DataFrame:
    """Those of ``ids`` (one column, each once) that are refined already.

    Only the id column is read, and only row groups in the span of ``ids``: folded
    segments are sorted, so of rising ids nearly all history is left out. The
    history is not shuffled unless ``ids`` are too many to be sent to all tasks;
    whether it is then thinned out by a bloom filter of ``ids`` first is left to
    Spark's own settings.
    """
    span = ids.agg(F.count(F.lit(1)).alias("n"), F.min(KEY).alias("lo"), F.max(KEY).alias("hi")).first()
    if not span["n"]:
        return ids
    refined = spark.table(table.name).select(KEY).where(c(KEY).between(span["lo"], span["hi"]))
    if span["n"] * _BYTES_PER_ID <= table.broadcast_bytes:
        # Measured just now.
        ids = F.broadcast(ids)
    return refined.join(ids, KEY, "left_semi")


def _new_files(spark: SparkSession, landing: str, table: SegmentTable) -> list[str]:
    """Names only, as many as Spark's own listing of the folder holds."""
    landed = accepted_orders(spark, landing, table.key_type).inputFiles()
    covered = {row["file"] for row in covered_files(spark, table).toLocalIterator()}
    return sorted(f for f in landed if _ACCEPTED_FOLDER in f and f not in covered)


def _append(spark: SparkSession, landing: str, table: SegmentTable, files: Sequence[str]) -> int:
    landed = (
        spark.read.schema(landing_schema(table.key_type))
        .option("basePath", landing)
        .parquet(*(unquote(f) for f in files))
        .drop("accepted", "payload")
    )
    known = known_ids(spark, table, landed.select(KEY).distinct())
    fresh = (
        landed.withColumn("customer_id", upper_trimmed(c("customer_id")))
        .dropDuplicates([KEY])
        .join(known, KEY, "left_anti")
        .withColumn("silver_load_timestamp", F.current_timestamp())
    )
    segment = _name(0)
    sources = spark.createDataFrame([(f,) for f in files], "file string").coalesce(1)
    n_rows = _write(spark, table, segment, fresh.select(*table.schema.names), sources)
    _show(spark, table, [*live_segments(spark, table), segment])
    return n_rows


def _write(
    spark: SparkSession, table: SegmentTable, segment: str, rows: DataFrame, sources: DataFrame
) -> int:
    """A segment with its ledger, registered but not yet named by the view."""
    sources.write.parquet(table.ledger(segment))
    observed, n_rows = counted(rows)
    observed.write.parquet(table.folder(segment))
    spark.sql(
        f"ALTER TABLE {table.parts} ADD PARTITION (segment = '{segment}') "
        f"LOCATION '{table.folder(segment)}'"
    )
    return n_rows.get["n_rows"]


def _show(spark: SparkSession, table: SegmentTable, segments: Sequence[str]) -> None:
    spark.catalog.refreshTable(table.parts)
    spark.sql(f"ALTER VIEW {table.name} AS {_reading(table, segments)}")


def _reading(table: SegmentTable, segments: Sequence[str]) -> str:
    named = ", ".join(f"'{s}'" for s in ["", *segments])
    return f"SELECT {', '.join(table.schema.names)} FROM {table.parts} WHERE segment IN ({named})"


def _name(tier: int) -> str:
    return f"{tier}-{uuid.uuid4().hex}"


def _full_tier(segments: Sequence[str], fan: int) -> list[str]:
    tiers = defaultdict(list)
    for segment in segments:
        tiers[int(segment.split("-")[0])].append(segment)
    return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan), [])


def _sweep(spark: SparkSession, table: SegmentTable, keep: Sequence[str]) -> None:
    """Remove segments that are neither live nor in ``keep``: folded ones, and those of failed runs."""
    stay = {*live_segments(spark, table), *keep}
    for row in spark.sql(f"SHOW PARTITIONS {table.parts}").collect():
        segment = row["partition"].split("=", 1)[1]
        if segment not in stay:
            spark.sql(f"ALTER TABLE {table.parts} DROP IF EXISTS PARTITION (segment = '{segment}')")
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for kind in ("rows", "sources"):
        folder = path_of(f"{table.root.rstrip('/')}/{kind}")
        filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in filesystem.listStatus(folder):
            name = found.getPath().getName()
            if name.startswith("segment=") and name.split("=", 1)[1] not in stay:
                filesystem.delete(found.getPath(), True)
