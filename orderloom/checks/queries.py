"""One runnable query per operator, over the driver's tables.

Queries that write do so in a new scratch folder and under database names of
their own, and return what they wrote, read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import catalog
from orderloom import functions as fn
from orderloom.operators import audit, rows
from orderloom.operators.skew import SkewPolicy
from orderloom.operators.star import DIMENSIONS, SalesStar, base_sales, base_sales_count
from orderloom.plans.colocated import FACTS, colocated_totals, deal_by_order
from orderloom.plans.gold import REPORTS, Totals
from orderloom.plans.runs import (
    Lakehouse,
    build_gold,
    build_silver,
    load_bronze,
    run_full_load,
    run_incremental,
    write_totals,
)
from orderloom.plans.silver import SILVER_PLANS
from orderloom.scratch import new_scratch, written
from orderloom.sinks.events import to_events
from orderloom.sinks.layers import replace_parquet, write_layer, write_layer_with_fingerprints
from orderloom.sinks.tables import publish_all
from orderloom.sources.events import file_events
from orderloom.sources.layers import read_catalog, read_layer
from orderloom.sources.sample_tables import driver_table, raw_tables, retail_tables
from orderloom.streaming.ingest import (
    accepted_orders,
    decode_payload,
    partly_read_events,
    rejected_events,
    start_ingest,
)
from orderloom.streaming.publish import latest_orders, publish_orders
from orderloom.streaming.progress import batches
from orderloom.streaming.refine import refined_orders, start_refine
from orderloom.streaming.segments import SegmentTable, refine_new

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

c = F.col

# The driver's ids are BIGINT.
KEY_TYPE = "bigint"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _lake(spark: SparkSession, purpose: str) -> Lakehouse:
    """Scratch folder and a database in it, for one call of one query."""
    root = new_scratch(spark, purpose)
    lake = Lakehouse(root, f"orderloom_{uuid.uuid4().hex}", KEY_TYPE)
    catalog.ensure_database(spark, lake.database, f"{root}/warehouse")
    return lake


def _finished(spark: SparkSession, lake: Lakehouse, result: DataFrame) -> DataFrame:
    """``result`` by way of files, so that the database of the call can go."""
    kept = written(spark, result, lake.layer("result"))
    catalog.drop_database(spark, lake.database)
    return kept


def _counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows bigint")


# ---- sources -------------------------------------------------------------


@query
def parquet_scan(spark, sf_dir):
    """Schema from the files."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


@query
def catalog_table_scan(spark, sf_dir):
    """All seven tables by way of the catalog, by fingerprint."""
    lake = _lake(spark, "catalog-scan")
    publish_all(retail_tables(spark, sf_dir), lake.database, lake.root)
    found = read_catalog(spark, lake.database, prefix="")
    return _finished(spark, lake, audit.fingerprints(found))


# ---- projection, filters -------------------------------------------------


@query
def rename_columns(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)["customers"]
    return rows.rename_source_columns(raw, "customers")


@query
def select_subset(spark, sf_dir):
    return retail_tables(spark, sf_dir)["products"].select(
        "product_id", "product_name", "category_id"
    )


@query
def filter_not_null_key(spark, sf_dir):
    return rows.with_key(raw_tables(spark, sf_dir)["orders"], "orderID")


@query
def filter_positive(spark, sf_dir):
    lines = retail_tables(spark, sf_dir)["order_details"]
    return rows.with_positive(lines, "discount")


@query
def drop_null_rows(spark, sf_dir):
    return rows.complete_rows(raw_tables(spark, sf_dir)["orders"])


@query
def delivery_status(spark, sf_dir):
    return retail_tables(spark, sf_dir)["orders"].select(
        "order_id", "shipped_date", "required_date", "delivery_status"
    )


# ---- joins ---------------------------------------------------------------


@query
def join_inner(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    headers = t["orders"].select("order_id", "customer_id", "order_date")
    return t["order_details"].join(headers, "order_id")


@query
def join_left(spark, sf_dir):
    """Dirty customers: orders of those without an id find no match."""
    t = retail_tables(spark, sf_dir)
    buyers = SILVER_PLANS["customers"](raw_tables(spark, sf_dir)["customers"])
    return (
        t["orders"]
        .select("order_id", "customer_id")
        .join(buyers.select("customer_id", "company"), "customer_id", "left")
    )


def _star(spark: SparkSession, sf_dir: str) -> SalesStar:
    return SalesStar.of(retail_tables(spark, sf_dir))


QUERIES["base_sales"] = lambda spark, sf_dir: base_sales(_star(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cleaned dirty tables of the star: stand-in ids, repeated keys."""
    raw = raw_tables(spark, sf_dir)
    return {t: SILVER_PLANS[t](raw[t], KEY_TYPE) for t in (*FACTS, *DIMENSIONS)}


def _cleaned_once(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``_cleaned`` by way of files, for what reads the tables several times."""
    folder = new_scratch(spark, "cleaned")
    # What no report reads is left out.
    write_layer(
        {t: df.drop("total_price", "ingestion_timestamp") for t, df in _cleaned(spark, sf_dir).items()},
        folder,
    )
    return read_layer(spark, folder, (*FACTS, *DIMENSIONS))


@query
def silver_base_sales(spark, sf_dir):
    """Base of the reports over cleaned tables, summed per order id."""
    return base_sales(SalesStar.of(_cleaned(spark, sf_dir)), per_order=True)


@query
def join_missing_keys(spark, sf_dir):
    """Lines and orders that lost their order id meet under its stand-in."""
    raw = raw_tables(spark, sf_dir)
    lines = SILVER_PLANS["order_details"](raw["order_details"], KEY_TYPE)
    orders = SILVER_PLANS["orders"](raw["orders"], KEY_TYPE)
    per_id = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("total_price").alias("gross")
    )
    orders_per_id = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_orders"))
    return per_id.join(orders_per_id, "order_id").select(
        "order_id", "gross", (c("n_lines") * c("n_orders")).alias("n_pairs")
    )


# ---- aggregation, distinct -----------------------------------------------


@query
def sum_by_customer(spark, sf_dir):
    orders = retail_tables(spark, sf_dir)["orders"]
    return orders.groupBy("customer_id").agg(F.sum("freight").alias("total_spend"))


@query
def distinct_rows(spark, sf_dir):
    return rows.distinct_rows(raw_tables(spark, sf_dir)["orders"])


@query
def dedup_by_key(spark, sf_dir):
    """Latest order of each customer."""
    orders = retail_tables(spark, sf_dir)["orders"].select(
        "customer_id", "order_id", "order_date", "freight"
    )
    return rows.newest_per_key(
        orders, "customer_id", [c("order_date").desc(), c("order_id").desc()]
    )


@query
def row_count_audit(spark, sf_dir):
    """Every table of every layer that reports need, and the joined base."""
    raw = raw_tables(spark, sf_dir)
    silver = {t: plan(raw[t], KEY_TYPE) for t, plan in SILVER_PLANS.items()}
    clean = retail_tables(spark, sf_dir)
    tables = audit.row_counts(
        {f"bronze/{t}": df for t, df in raw.items()}
        | {f"silver/{t}": df for t, df in silver.items()}
        | {f"gold/{t}": df for t, df in clean.items() if t != "categories"}
    )
    base = base_sales_count(SalesStar.of(clean))
    return tables.unionAll(base.select(F.lit("gold/base_sales"), "n_rows"))


# ---- scalar functions ----------------------------------------------------


@query
def str_trim(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)["categories"]
    return raw.select("categoryID", F.trim("categoryName").alias("category_name"))


@query
def str_upper(spark, sf_dir):
    part = driver_table(spark, sf_dir)("part")
    return part.select("p_partkey", F.upper("p_name").alias("product_name"))


@query
def str_lower(spark, sf_dir):
    part = driver_table(spark, sf_dir)("part")
    return part.select("p_partkey", F.lower("p_brand").alias("brand"))


@query
def str_strip_replacement_char(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)["products"]
    return raw.select("productID", fn.strip_replacement_char(c("productName")).alias("name"))


@query
def normalize_pack_size(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)["products"]
    return raw.select("productID", fn.pack_size(c("quantityPerUnit")).alias("quantity_per_unit"))


@query
def year_month_label(spark, sf_dir):
    """Shipping month; orders that were not shipped have no year and an empty label."""
    shipped = retail_tables(spark, sf_dir)["orders"].select(
        "order_id",
        F.year("shipped_date").alias("shipped_year"),
        F.month("shipped_date").alias("shipped_month"),
    )
    return shipped.withColumn(
        "year_month", fn.year_month_label(c("shipped_year"), c("shipped_month"))
    )


@query
def cast_int_lenient(spark, sf_dir):
    """Whole numerals, numerals with a fraction, words, and values out of range."""
    lines = driver_table(spark, sf_dir)("lineitem")
    text = F.concat(F.lit(" "), c("l_extendedprice").cast("string"))
    return lines.select(
        "l_orderkey",
        "l_extendedprice",
        fn.to_int(text).alias("whole_price"),
        fn.to_int(c("l_returnflag")).alias("flag_number"),
        fn.to_int(c("l_partkey").cast("string")).alias("part_number"),
        fn.to_int(F.concat(F.lit("99999999"), c("l_orderkey").cast("string"))).alias("too_big"),
    )


@query
def cast_string(spark, sf_dir):
    orders = driver_table(spark, sf_dir)("orders")
    return orders.select("o_orderkey", fn.to_text(c("o_custkey")).alias("customer_id"))


@query
def cast_decimal(spark, sf_dir):
    """Text with one digit too many; nine digits too many do not fit."""
    text = c("l_extendedprice").cast("decimal(12,2)").cast("string")
    return driver_table(spark, sf_dir)("lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        fn.to_decimal(F.concat(text, F.lit("5")), 10, 2).alias("price"),
        fn.to_decimal(F.concat(F.lit("123456789"), text), 10, 2).alias("too_big"),
        fn.to_decimal(c("l_discount").cast("string"), 5, 2).alias("discount"),
    )


@query
def parse_iso_date(spark, sf_dir):
    """ISO dates, dates with a time, dates in another layout."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return driver_table(spark, sf_dir)("orders").select(
        "o_orderkey",
        fn.to_iso_date(text).alias("from_iso"),
        fn.to_iso_date(F.concat(text, F.lit(" 10:00:00"))).alias("from_time"),
        fn.to_iso_date(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("from_other"),
    )


@query
def round_half_up(spark, sf_dir):
    """Halves of a cent, of either sign."""
    half = c("l_extendedprice").cast("decimal(12,2)") * F.lit(Decimal("0.125"))
    return driver_table(spark, sf_dir)("lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        fn.round_money(half).alias("up"),
        fn.round_money(-half).alias("down"),
    )


@query
def fill_missing_keys(spark, sf_dir):
    """Open orders lose their id, those of the last shipper their customer."""
    orders = retail_tables(spark, sf_dir)["orders"].select(
        F.when(c("delivery_status") != "PENDING", c("order_id")).alias("order_id"),
        F.when(c("shipper_id") < 5, c("customer_id")).alias("customer_id"),
    )
    return rows.fill_missing(
        orders, {"order_id": rows.MISSING_ID, "customer_id": rows.MISSING_CODE}
    )


@query
def line_total(spark, sf_dir):
    lines = retail_tables(spark, sf_dir)["order_details"]
    return lines.withColumn("total_price", fn.line_total(c("unit_price"), c("quantity")))


@query
def net_sales(spark, sf_dir):
    """A line without a readable discount has no net sales."""
    lines = SILVER_PLANS["order_details"](raw_tables(spark, sf_dir)["order_details"], KEY_TYPE)
    return lines.withColumn(
        "net_sales", fn.net_sales(c("unit_price"), c("quantity"), c("discount"))
    )


# ---- silver tables, reports ----------------------------------------------


def _silver(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = SILVER_PLANS[table](raw_tables(spark, sf_dir)[table], KEY_TYPE)
    return cleaned.drop("ingestion_timestamp")


def _report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return REPORTS[name](Totals(_star(spark, sf_dir)))


QUERIES |= {f"silver_{table}": partial(_silver, table) for table in SILVER_PLANS}
QUERIES |= {name: partial(_report, name) for name in REPORTS}


def _silver_report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and headers are counted, searched for heavy ids and read up to twice."""
    on_headers_alone = name == "report_orders_by_delivery_status"
    tables = (_cleaned if on_headers_alone else _cleaned_once)(spark, sf_dir)
    return REPORTS[name](Totals(SalesStar.of(tables)))


QUERIES |= {f"silver_{name}": partial(_silver_report, name) for name in REPORTS}


# ---- sinks, catalog ------------------------------------------------------


@query
def full_load_bronze(spark, sf_dir):
    """All rows of all seven bronze tables, read back; equal to what the writes observed."""
    lake = _lake(spark, "bronze")
    seen = write_layer_with_fingerprints(raw_tables(spark, sf_dir), lake.layer("bronze"))
    catalog.drop_database(spark, lake.database)
    found = read_layer(spark, lake.layer("bronze"))
    audit.require_same(seen, found)
    named = [df.select(F.lit(t).alias("table_name"), "*") for t, df in found.items()]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), named)


def _silver_lake(spark: SparkSession, sf_dir: str, purpose: str) -> Lakehouse:
    lake = _lake(spark, purpose)
    load_bronze(raw_tables(spark, sf_dir).__getitem__, lake)
    build_silver(spark, lake)
    return lake


@query
def register_external(spark, sf_dir):
    """All seven curated tables by way of their external tables, by fingerprint."""
    lake = _silver_lake(spark, sf_dir, "external")
    found = read_catalog(spark, lake.database)
    return _finished(spark, lake, audit.fingerprints(found, leave_out=["ingestion_timestamp"]))


@query
def catalog_tables(spark, sf_dir):
    """Databases and tables as the catalog lists them, and the tables' row counts."""
    lake = _silver_lake(spark, sf_dir, "catalog")
    counts = audit.row_counts(catalog.table_contents(spark, lake.database))
    listed = catalog.list_databases(spark).count(lake.database)
    database = spark.createDataFrame([("database", listed)], counts.schema)
    return _finished(spark, lake, counts.unionAll(database))


@query
def publish_report_table(spark, sf_dir):
    """All seven reports published twice over and read back, by fingerprint."""
    lake = _lake(spark, "reports")
    write_layer(
        {
            t: SILVER_PLANS[t](df, KEY_TYPE)
            for t, df in _as_raw(retail_tables(spark, sf_dir)).items()
        },
        lake.layer("silver"),
    )
    catalog.register_external(spark, lake.database, lake.layer("silver"), key_type=KEY_TYPE)
    for _ in range(2):
        build_gold(spark, lake)
    reports = {name: spark.table(f"{lake.database}.{name}") for name in REPORTS}
    return _finished(spark, lake, audit.fingerprints(reports))


@query
def colocated_reports(spark, sf_dir):
    """All seven reports over cleaned tables whose lines and orders lie in buckets, by fingerprint."""
    policy = SkewPolicy(min_rows=1000)
    lake = _lake(spark, "colocated")
    write_layer(_cleaned(spark, sf_dir), lake.layer("silver"))
    silver = read_layer(spark, lake.layer("silver"), (*FACTS, *DIMENSIONS))
    deal_by_order(spark, silver, lake.database, 16, policy)
    totals = write_totals(spark, colocated_totals(spark, lake.database, silver, policy))
    reports = {name: report(totals, ordered=False) for name, report in REPORTS.items()}
    return _finished(spark, lake, audit.fingerprints(reports))


def _as_raw(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Derived columns are computed anew by the cleaning plans."""
    return tables | {"orders": tables["orders"].drop("delivery_status")}


@query
def full_load_run(spark, sf_dir):
    lake = _lake(spark, "full-load")
    counts = run_full_load(spark, raw_tables(spark, sf_dir).__getitem__, lake)
    catalog.drop_database(spark, lake.database)
    return _counts(spark, counts)


@query
def full_load_kpi(spark, sf_dir):
    """KPI table of a full load: lost order ids count as one more order."""
    lake = _lake(spark, "full-load-kpi")
    run_full_load(spark, raw_tables(spark, sf_dir).__getitem__, lake)
    return _finished(spark, lake, spark.table(f"{lake.database}.report_kpi_summary"))


# ---- events --------------------------------------------------------------


def _order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON messages; dates as text, as a producer would send them."""
    orders = retail_tables(spark, sf_dir)["orders"].drop("delivery_status")
    return to_events(
        orders.withColumns(
            {
                "customer_id": F.concat(F.lit(" c"), c("customer_id"), F.lit(" ")),
                "freight": c("freight").cast("double"),
            }
        )
    )


def _faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in process send what is not JSON, filled orders an id of the wrong type.

    Of the others, every fifth has a freight that cannot be read.
    """
    status = driver_table(spark, sf_dir)("orders").select(
        c("o_orderkey").alias("order_id"), c("o_orderstatus").alias("status")
    )
    events = _order_events(spark, sf_dir)
    order_id = F.get_json_object(c("value").cast("string"), "$.order_id").cast("bigint")
    text = c("value").cast("string")
    return (
        events.withColumn("order_id", order_id)
        .join(status, "order_id")
        .select(
            F.when(c("status") == "P", F.concat(F.lit("order "), c("order_id").cast("string")))
            .when(
                c("status") == "F",
                F.concat(F.lit('{"order_id":"no '), c("order_id").cast("string"), F.lit('"}')),
            )
            .when(
                c("order_id") % 5 == 0,
                F.regexp_replace(text, r'"freight":([^,}]+)', r'"freight":"$1 EUR"'),
            )
            .otherwise(text)
            .cast("binary")
            .alias("value")
        )
    )


@query
def order_events_to_json(spark, sf_dir):
    """Events of the clickstream table as JSON and back; no digit is lost."""
    events = driver_table(spark, sf_dir)("events")
    layout = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    parsed = F.from_json(c("value").cast("string"), events.schema, layout)
    return to_events(events).select(parsed.alias("event")).select("event.*")


@query
def json_parse_flatten(spark, sf_dir):
    decoded = decode_payload(_faulty_events(spark, sf_dir), KEY_TYPE)
    return decoded.drop("payload")


def _ingested(spark: SparkSession, events: DataFrame, purpose: str) -> Lakehouse:
    lake = _lake(spark, purpose)
    replace_parquet(events, lake.layer("arrivals"))
    start_ingest(
        file_events(spark, lake.layer("arrivals")),
        lake.stream("bronze"),
        lake.checkpoint("ingest"),
        key_type=KEY_TYPE,
    ).awaitTermination()
    return lake


@query
def stream_order_ingest(spark, sf_dir):
    lake = _ingested(spark, _faulty_events(spark, sf_dir), "ingest")
    landed = accepted_orders(spark, lake.stream("bronze"), KEY_TYPE)
    catalog.drop_database(spark, lake.database)
    return landed.drop("ingestion_timestamp")


@query
def stream_partly_read(spark, sf_dir):
    """Orders with a field that could not be read, and what was sent."""
    lake = _ingested(spark, _faulty_events(spark, sf_dir), "partly-read")
    catalog.drop_database(spark, lake.database)
    found = partly_read_events(spark, lake.stream("bronze"), KEY_TYPE)
    sent = F.get_json_object("payload", "$.freight").alias("sent_freight")
    return found.select("order_id", F.regexp_extract(sent, " (EUR)$", 1).alias("unit"))


@query
def stream_rejects(spark, sf_dir):
    lake = _ingested(spark, _faulty_events(spark, sf_dir), "rejects")
    catalog.drop_database(spark, lake.database)
    return rejected_events(spark, lake.stream("bronze"), KEY_TYPE).select("payload")


@query
def stream_batch_counts(spark, sf_dir):
    """What an interval run says of its batches, until it has been idle."""
    lake = _lake(spark, "batch-counts")
    replace_parquet(_faulty_events(spark, sf_dir), lake.layer("arrivals"))
    running = start_ingest(
        file_events(spark, lake.layer("arrivals"), {"maxFilesPerTrigger": "4"}),
        lake.stream("bronze"),
        lake.checkpoint("ingest"),
        interval="1 second",
        key_type=KEY_TYPE,
    )
    totals = dict.fromkeys(("rows", "accepted", "rejected"), 0)
    for batch in batches(running, idle_seconds=3):
        totals = {name: n + batch.counts[name] for name, n in totals.items()}
    catalog.drop_database(spark, lake.database)
    return spark.createDataFrame(list(totals.items()), "counted string, n bigint")


def _refined(spark: SparkSession, sf_dir: str, purpose: str) -> Lakehouse:
    """Every order arrives twice; the refinement runs, is restarted, and runs again."""
    events = _order_events(spark, sf_dir)
    lake = _ingested(spark, events.unionAll(events), purpose)
    for _ in range(2):
        start_refine(
            spark,
            lake.stream("bronze"),
            lake.stream("silver"),
            lake.checkpoint("refine"),
            key_type=KEY_TYPE,
        ).awaitTermination()
    return lake


@query
def stream_orders_silver(spark, sf_dir):
    lake = _refined(spark, sf_dir, "refine")
    silver = refined_orders(spark, lake.stream("silver"), KEY_TYPE)
    catalog.drop_database(spark, lake.database)
    return silver.drop("ingestion_timestamp", "silver_load_timestamp")


@query
def stream_orders_segments(spark, sf_dir):
    """Every order arrives twice; lots of files become segments, which are folded in pairs."""
    events = _order_events(spark, sf_dir)
    lake = _ingested(spark, events.unionAll(events), "segments")
    table = SegmentTable(f"{lake.database}.orders", lake.layer("segments"), KEY_TYPE, fan=2)
    for _ in range(2):
        refine_new(spark, lake.stream("bronze"), table, max_files=4)
    found = spark.table(table.name).drop("ingestion_timestamp", "silver_load_timestamp")
    return _finished(spark, lake, found)


@query
def publish_stream_table(spark, sf_dir):
    lake = _refined(spark, sf_dir, "stream-table")
    publish_orders(spark, lake.stream("silver"), lake.stream_table, KEY_TYPE)
    found = spark.table(lake.stream_table).drop("ingestion_timestamp", "silver_load_timestamp")
    return _finished(spark, lake, found)


@query
def latest_orders_preview(spark, sf_dir):
    lake = _refined(spark, sf_dir, "preview")
    publish_orders(spark, lake.stream("silver"), lake.stream_table, KEY_TYPE)
    newest = latest_orders(spark, lake.stream_table)
    found = newest.drop("ingestion_timestamp", "silver_load_timestamp")
    return _finished(spark, lake, found)


@query
def incremental_run(spark, sf_dir):
    """Two runs over the same arrivals, the second of which adds nothing."""
    lake = _lake(spark, "incremental")
    replace_parquet(_faulty_events(spark, sf_dir), lake.layer("arrivals"))
    for _ in range(2):
        run_incremental(spark, file_events(spark, lake.layer("arrivals")), lake)
    counts = audit.row_counts(
        {
            "bronze": accepted_orders(spark, lake.stream("bronze"), KEY_TYPE),
            "rejected": rejected_events(spark, lake.stream("bronze"), KEY_TYPE),
            "silver": refined_orders(spark, lake.stream("silver"), KEY_TYPE),
            "table": spark.table(lake.stream_table),
        }
    )
    return _finished(spark, lake, counts)
