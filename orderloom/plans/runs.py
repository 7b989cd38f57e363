"""The two complete runs: full load of all tables, incremental load of order events.

A run takes sources and folders from its caller, never stops the session, and
returns the row count of everything it wrote. A layer that stays empty fails it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from orderloom import catalog
from orderloom.operators.audit import require_rows
from orderloom.operators.skew import SkewPolicy
from orderloom.operators.star import SalesStar
from orderloom.plans.colocated import colocated_totals, deal_by_order
from orderloom.plans.gold import REPORTS, Totals
from orderloom.plans.silver import SILVER_PLANS
from orderloom.schemas import TABLES
from orderloom.scratch import new_scratch, written
from orderloom.sinks.layers import write_layer
from orderloom.sinks.parallel import in_parallel
from orderloom.sinks.tables import publish_all
from orderloom.sources.layers import read_catalog, read_layer
from orderloom.sources.relational import TableReader
from orderloom.streaming.ingest import start_ingest
from orderloom.streaming.publish import publish_orders
from orderloom.streaming.refine import start_refine
from orderloom.streaming.segments import SegmentTable, refine_new

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lakehouse:
    """Where a run writes: a root folder with one folder per layer, and a database."""

    root: str
    database: str
    key_type: str = "int"

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def stream(self, layer: str) -> str:
        return f"{self.layer(layer)}/orders_stream"

    def checkpoint(self, name: str) -> str:
        return f"{self.layer('checkpoints')}/{name}"

    @property
    def stream_table(self) -> str:
        return f"{self.database}.orders_stream"

    @property
    def segments(self) -> SegmentTable:
        """Refined orders as segments; readers use the view that it names."""
        return SegmentTable(
            f"{self.database}.orders_refined", f"{self.layer('silver')}/orders_segments", self.key_type
        )


def load_bronze(
    read: TableReader, lake: Lakehouse, tables: Iterable[str] = TABLES
) -> dict[str, int]:
    """Source tables as they are, one parquet directory each."""
    return write_layer({t: read(t) for t in tables}, lake.layer("bronze"))


def build_silver(spark: SparkSession, lake: Lakehouse) -> dict[str, int]:
    """Cleaned tables as parquet, registered as external tables."""
    bronze = read_layer(spark, lake.layer("bronze"))
    cleaned = {t: plan(bronze[t], lake.key_type) for t, plan in SILVER_PLANS.items()}
    counts = write_layer(cleaned, lake.layer("silver"))
    catalog.ensure_database(spark, lake.database)
    catalog.register_external(spark, lake.database, lake.layer("silver"), key_type=lake.key_type)
    return counts


def build_gold(
    spark: SparkSession,
    lake: Lakehouse,
    policy: SkewPolicy | None = None,
    buckets: int | None = None,
) -> dict[str, int]:
    """All reports as tables.

    The two pre-aggregations are written once to the shared scratch folder:
    order lines are read twice in all, not once per report, and a lost
    executor does not lose them. With ``buckets``, lines and headers are first
    dealt into as many buckets of their order id, in tables of the database that
    later work by order reads without a shuffle.
    """
    silver = read_catalog(spark, lake.database)
    if buckets:
        deal_by_order(spark, silver, lake.database, buckets, policy)
        plan = colocated_totals(spark, lake.database, silver, policy)
    else:
        plan = Totals(SalesStar.of(silver, policy))
    totals = write_totals(spark, plan)
    reports = {name: report(totals, ordered=False) for name, report in REPORTS.items()}
    return publish_all(reports, lake.database, lake.layer("gold"))


def write_totals(spark: SparkSession, plan: Totals) -> Totals:
    folder = new_scratch(spark, "sales-totals")
    totals = {"by_order": plan.by_order, "by_product": plan.by_product}
    files = in_parallel(
        spark, {name: partial(written, spark, df, f"{folder}/{name}") for name, df in totals.items()}
    )
    return Totals(plan.star, files["by_order"], files["by_product"])


def run_full_load(
    spark: SparkSession,
    read: TableReader,
    lake: Lakehouse,
    policy: SkewPolicy | None = None,
    buckets: int | None = None,
) -> dict[str, int]:
    """Source → bronze → silver → gold; row counts by ``layer/table``."""
    counts: dict[str, int] = {}
    steps = {
        "bronze": lambda: load_bronze(read, lake),
        "silver": lambda: build_silver(spark, lake),
        "gold": lambda: build_gold(spark, lake, policy, buckets),
    }
    for layer, step in steps.items():
        written_rows = {f"{layer}/{name}": n for name, n in step().items()}
        require_rows(written_rows)
        log.info("%s written: %s", layer, written_rows)
        counts |= written_rows
    return counts


def run_incremental(
    spark: SparkSession,
    events: DataFrame,
    lake: Lakehouse,
    batch_limits: Mapping[str, str] | None = None,
) -> int:
    """Ingest what has arrived, refine it, publish it; rows in the published table.

    Each step drains its input and returns, so the next one always runs; a
    failed run is repeated with the same checkpoints and repeats no row.
    ``batch_limits`` bound the micro-batches of the refinement.
    """
    start_ingest(
        events, lake.stream("bronze"), lake.checkpoint("ingest"), key_type=lake.key_type
    ).awaitTermination()
    start_refine(
        spark,
        lake.stream("bronze"),
        lake.stream("silver"),
        lake.checkpoint("refine"),
        key_type=lake.key_type,
        batch_limits=batch_limits,
    ).awaitTermination()
    return publish_stream(spark, lake)


def run_incremental_segments(
    spark: SparkSession, events: DataFrame, lake: Lakehouse, max_files: int = 10_000
) -> int:
    """Ingest what has arrived and refine it into segments; orders in their view.

    The view is what readers use: there is no copy to publish, and no state. Not to
    be mixed with ``run_incremental`` on one lakehouse: each keeps its own orders.
    """
    start_ingest(
        events, lake.stream("bronze"), lake.checkpoint("ingest"), key_type=lake.key_type
    ).awaitTermination()
    added = refine_new(spark, lake.stream("bronze"), lake.segments, max_files)
    n_rows = spark.table(lake.segments.name).count()
    require_rows({lake.segments.name: n_rows})
    log.info("%s: %d rows, %d of them new", lake.segments.name, n_rows, added)
    return n_rows


def publish_stream(spark: SparkSession, lake: Lakehouse) -> int:
    """Refined orders as a table; returns its row count."""
    catalog.ensure_database(spark, lake.database)
    n_rows = publish_orders(
        spark,
        lake.stream("silver"),
        lake.stream_table,
        lake.key_type,
        progress=lake.checkpoint("publish"),
    )
    require_rows({lake.stream_table: n_rows})
    log.info("%s: %d rows", lake.stream_table, n_rows)
    return n_rows
