"""Order lines and headers that lie together by order id, and the totals made from them.

Every report joins lines with headers by order id, and sums lines per order. Dealt
once into the same buckets of that id, both are read where they lie: neither the sum
nor the join shuffles. An id with very many rows would make one bucket, and so one
task, of all of them. Rows of such ids are kept in plain tables beside the buckets:
totals of different ids do not depend on each other, so those of heavy ids are made
the usual way, with sums in each task before the shuffle, and put beside the rest.

Everything is read through views. Dealing again writes new tables and then points
the views at them; the tables before stay for their readers, older ones go.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import star as st
from orderloom.operators.audit import counted
from orderloom.operators.skew import KeyLoads, SkewPolicy, key_loads
from orderloom.operators.star import DIMENSIONS, SalesStar
from orderloom.plans.gold import Totals
from orderloom.sinks.parallel import in_parallel

c = F.col

KEY = "order_id"
FACTS = ("order_details", "orders")
_KINDS = ("dealt", "heavy")


def deal_by_order(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    database: str,
    buckets: int,
    policy: SkewPolicy | None = None,
) -> dict[str, int]:
    """Deal lines and headers into ``buckets``; returns the rows of each table written.

    ``<table>_by_order`` is the view of all rows of a table, ``<table>_dealt`` and
    ``<table>_heavy`` of its two parts. Choose ``buckets`` so that a bucket of lines
    is what a task should read; both tables have the same number. ``policy`` tells
    which ids are heavy, in either table, and both keep these aside.
    """
    policy = policy or SkewPolicy()
    heavy = sorted({k for t in FACTS for k in key_loads(tables[t], KEY, policy).keys})
    # At most max_keys + max_split_keys values of each table.
    is_heavy = F.coalesce(c(KEY).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    version = uuid.uuid4().hex
    saves, written = {}, {}
    for table in FACTS:
        for kind, rows in zip(_KINDS, (tables[table].where(~is_heavy), tables[table].where(is_heavy)), strict=True):
            name = f"{database}.{table}_{kind}_{version}"
            saves[f"{table}_{kind}"] = partial(_save, rows, name, buckets if kind == "dealt" else None)
            written[f"{table}_{kind}"] = name
    counts = in_parallel(spark, saves)
    before = _targets(spark, database)
    for view, name in written.items():
        _point(spark, f"{database}.{view}", f"SELECT * FROM {name}")
    for table in FACTS:
        parts = (f"SELECT * FROM {database}.{table}_{kind}" for kind in _KINDS)
        _point(spark, f"{database}.{table}_by_order", " UNION ALL ".join(parts))
    _drop_versions(spark, database, {version, *before})
    return counts


def colocated_totals(
    spark: SparkSession,
    database: str,
    dimensions: Mapping[str, DataFrame],
    policy: SkewPolicy | None = None,
) -> Totals:
    """Totals for all reports, from the tables that ``deal_by_order`` has written."""
    policy = policy or SkewPolicy()
    dims = {name: dimensions[name] for name in DIMENSIONS}
    whole = SalesStar.of({t: spark.table(f"{database}.{t}_by_order") for t in FACTS} | dims, policy)
    known = replace(whole, known_dimensions=whole.dimensions)

    def part(kind: str, **loads: KeyLoads) -> SalesStar:
        return replace(known, **{t: spark.table(f"{database}.{t}_{kind}") for t in FACTS}, **loads)

    # What is in buckets has no heavy ids; what is heavy must be so by the same measure as for the whole.
    dealt = part("dealt", order_loads=KeyLoads(), line_loads=KeyLoads())
    heavy = part("heavy", order_loads=whole.loads_in_orders)
    by_order = st.order_totals(dealt).unionByName(st.order_totals(heavy))
    by_product = (
        st.product_totals(dealt)
        .unionByName(st.product_totals(heavy))
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("quantity"), F.sum("net_sales").cast(st.TOTAL_TYPE).alias("net_sales"))
    )
    return Totals(replace(known, order_loads=whole.loads_in_orders), by_order, by_product)


def _save(rows: DataFrame, name: str, buckets: int | None) -> int:
    """A managed table; each bucket is written by the one task that has its rows, as one file."""
    observed, n_rows = counted(rows.repartition(buckets, KEY) if buckets else rows)
    writer = observed.write.format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, KEY).sortBy(KEY)
    writer.saveAsTable(name)
    return n_rows.get["n_rows"]


def _point(spark: SparkSession, view: str, query: str) -> None:
    change = "ALTER" if spark.catalog.tableExists(view) else "CREATE"
    spark.sql(f"{change} VIEW {view} AS {query}")


def _versions(spark: SparkSession, database: str) -> dict[str, str]:
    """Tables of parts, with their version."""
    names = (t.name for t in spark.catalog.listTables(database) if t.tableType == "MANAGED")
    parts = tuple(f"{t}_{kind}_" for t in FACTS for kind in _KINDS)
    return {n: n.rsplit("_", 1)[1] for n in names if n.startswith(parts)}


def _targets(spark: SparkSession, database: str) -> set[str]:
    """Versions that the views point at."""
    texts = []
    for view in (f"{database}.{t}_{kind}" for t in FACTS for kind in _KINDS):
        if spark.catalog.tableExists(view):
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {view}").where("col_name = 'View Text'")
            texts.append(described.first()["data_type"])
    return {text.rsplit("_", 1)[1] for text in texts}


def _drop_versions(spark: SparkSession, database: str, keep: set[str]) -> None:
    for name, version in _versions(spark, database).items():
        if version not in keep:
            spark.sql(f"DROP TABLE {database}.{name}")
