"""Readers, writers, catalog, scratch folders and the full run."""

from __future__ import annotations

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom import catalog
from orderloom.checks.queries import KEY_TYPE
from orderloom.operators import audit
from orderloom.operators.audit import MissingOutput
from orderloom.plans.runs import Lakehouse, build_silver, load_bronze, run_full_load
from orderloom.schemas import TABLES, silver_schema
from orderloom.scratch import new_scratch, scratch_root
from orderloom.sinks.events import send_to_kafka
from orderloom.sinks.layers import append_parquet, replace_parquet, write_layer_with_fingerprints
from orderloom.sinks.parallel import in_parallel
from orderloom.sinks.tables import publish_at_path, publish_managed, table_location
from orderloom.sources.events import kafka_events
from orderloom.sources.layers import read_catalog, read_layer
from orderloom.sources.relational import RangeSplit, jdbc_reader, jdbc_table
from orderloom.sources.sample_tables import raw_tables


class Recorder:
    """Stands in for a reader: keeps the options of each load."""

    def __init__(self, bounds=(None, None)):
        self.bounds, self.loads = bounds, []

    @property
    def read(self):
        return _Reader(self)

    readStream = write = read


class _Reader:
    def __init__(self, recorder):
        self.recorder, self.seen = recorder, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def options(self, **values):
        self.seen.update(values)
        return self

    def load(self):
        self.recorder.loads.append(self.seen)
        return self

    def first(self):
        return self.recorder.bounds

    def select(self, *columns):
        self.seen["columns"] = columns
        return self

    def save(self):
        self.recorder.loads.append(self.seen)


URL = "jdbc:postgresql://db.example/shop"
LOGIN = {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}


def test_jdbc_table_without_split():
    spark = Recorder()
    jdbc_table(spark, URL, "orders", LOGIN)
    (load,) = spark.loads
    assert load["url"] == URL and load["dbtable"] == "orders" and load["user"] == "u"
    assert load["format"] == "jdbc" and "partitionColumn" not in load


def test_jdbc_table_by_ranges():
    spark = Recorder()
    jdbc_table(spark, URL, "orders", LOGIN, RangeSplit("order_id", 64, 1, 9_000_000))
    (load,) = spark.loads
    assert (load["partitionColumn"], load["numPartitions"]) == ("order_id", 64)
    assert (load["lowerBound"], load["upperBound"]) == ("1", "9000000")


def test_jdbc_bounds_are_asked_from_the_database():
    spark = Recorder(bounds=(5, 50))
    jdbc_table(spark, URL, "orders", LOGIN, RangeSplit("order_id", 8))
    asked, load = spark.loads
    assert "MIN(order_id)" in asked["dbtable"] and "FROM orders" in asked["dbtable"]
    assert (load["lowerBound"], load["upperBound"]) == ("5", "50")


def test_jdbc_table_without_rows_is_not_split():
    spark = Recorder()
    jdbc_table(spark, URL, "orders", LOGIN, RangeSplit("order_id", 8))
    assert "partitionColumn" not in spark.loads[-1]


def test_jdbc_reader_by_table_name():
    spark = Recorder()
    read = jdbc_reader(spark, URL, LOGIN, "shop", {"orders": RangeSplit("order_id", 4, 0, 9)})
    read("orders")
    read("shippers")
    orders, shippers = spark.loads
    assert orders["dbtable"] == "shop.orders" and orders["numPartitions"] == 4
    assert shippers["dbtable"] == "shop.shippers" and "numPartitions" not in shippers


def test_kafka_options():
    spark = Recorder()
    kafka_events(spark, "broker:9092", "orders", {"maxOffsetsPerTrigger": "1000"})
    (load,) = spark.loads
    assert load["format"] == "kafka" and load["subscribe"] == "orders"
    assert load["startingOffsets"] == "earliest" and load["failOnDataLoss"] == "false"
    assert load["maxOffsetsPerTrigger"] == "1000" and load["columns"] == ("value",)


def test_kafka_sink_options():
    frame = Recorder()
    send_to_kafka(frame, "broker:9092", "orders")
    (save,) = frame.loads
    assert save == {"format": "kafka", "kafka.bootstrap.servers": "broker:9092", "topic": "orders"}


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_parquet(spark.range(5), path) == 5
    assert append_parquet(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8
    assert replace_parquet(spark.range(2), path) == 2
    # The version before is kept for its readers.
    assert len(list(Path(path).glob("version-*"))) == 2


def test_a_failed_write_is_raised_and_the_others_are_done(spark, tmp_path):
    def fail():
        raise RuntimeError("no space")

    path = str(tmp_path / "t")
    jobs = {"bad": fail, "good": lambda: replace_parquet(spark.range(3), path)}
    with pytest.raises(RuntimeError, match="no space"):
        in_parallel(spark, jobs)
    assert spark.read.parquet(path).count() == 3


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    catalog.ensure_database(spark, name, str(tmp_path / "warehouse"))
    catalog.ensure_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_are_replaced(spark, tmp_path, database):
    path = str(tmp_path / "report")
    for n in (4, 2):
        assert publish_at_path(spark.range(n), f"{database}.report", path) == n
        assert publish_managed(spark.range(n), f"{database}.managed") == n
    assert spark.table(f"{database}.report").count() == 2
    # The version before is kept for its readers.
    assert len(list(Path(path).glob("version-*"))) == 2
    assert spark.table(f"{database}.managed").count() == 2
    assert catalog.list_tables(spark, database) == ["managed", "report"]
    assert database in catalog.list_databases(spark)


def test_a_failed_publication_leaves_the_old_report(spark, tmp_path, database):
    table, path = f"{database}.report", str(tmp_path / "report")
    publish_at_path(spark.range(3), table, path)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish_at_path(broken, table, path)
    assert sorted(r["id"] for r in spark.table(table).collect()) == [0, 1, 2]
    # What the failed write left is gone after the next one.
    publish_at_path(spark.range(4), table, path)
    assert len(list(Path(path).glob("version-*"))) == 2
    assert spark.table(table).count() == 4


def test_a_reader_keeps_its_version_and_columns_may_change(spark, tmp_path, database):
    table, path = f"{database}.report", str(tmp_path / "report")
    publish_at_path(spark.range(3), table, path)
    reading = spark.table(table)
    publish_at_path(spark.range(9), table, path)
    assert (reading.count(), spark.table(table).count()) == (3, 9)
    publish_at_path(spark.range(2).withColumn("name", F.lit("x")), table, path)
    assert [tuple(r) for r in spark.table(table).orderBy("id").collect()] == [(0, "x"), (1, "x")]


def test_fingerprints_tell_tables_apart_but_not_orders_of_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "", "b"), (2, "", "b")], "k int, t string, `odd name` string")
    variants = {
        "same": df.orderBy("t", ascending=False).select("odd name", "t", "k"),
        "fewer": df.distinct(),
        "twice": df.unionAll(df),
        "value": df.withColumn("t", F.coalesce(F.nullif("t", F.lit("")), F.lit("c"))),
        "null": df.withColumn("t", F.nullif("t", F.lit(""))),
        "moved": df.select("k", F.col("odd name").alias("t"), F.col("t").alias("odd name")),
        "none": df.limit(0),
    }
    found = {r["table_name"]: tuple(r)[1:] for r in audit.fingerprints({"df": df, **variants}).collect()}
    assert found.pop("same") == found["df"]
    assert len(set(found.values())) == len(found)
    assert found["none"] == (0, 0, 0)
    # Rows that are there twice cancel each other in one of the numbers only.
    assert found["twice"][2] == 0 != found["twice"][1]


def test_written_layers_are_compared_with_their_sources(spark, tmp_path):
    root = str(tmp_path / "layer")
    seen = write_layer_with_fingerprints({"a": spark.range(50), "b": spark.range(0)}, root)
    assert seen["a"]["n_rows"] == 50 and seen["b"] == {"n_rows": 0, "digest_sum": 0, "digest_xor": 0}
    audit.require_same(seen, read_layer(spark, root, ["a", "b"]))
    append_parquet(spark.range(1), f"{root}/b")
    with pytest.raises(audit.ChangedOutput, match="written: b"):
        audit.require_same(seen, read_layer(spark, root, ["a", "b"]))


def test_dropping_an_external_table_keeps_its_files(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    schema = silver_schema("shippers")
    replace_parquet(spark.createDataFrame([(1, "s")], schema), f"{root}/shippers")
    (name,) = catalog.register_external(spark, database, root, ["shippers"])
    assert spark.table(name).schema == schema
    catalog.register_external(spark, database, root, ["shippers"])
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(f"{root}/shippers").count() == 1


def test_use_database_and_refresh(spark, tmp_path, database):
    before = spark.catalog.currentDatabase()
    path = str(tmp_path / "t")
    publish_at_path(spark.range(1), f"{database}.t", path)
    assert spark.table(f"{database}.t").count() == 1
    append_parquet(spark.range(1), table_location(spark, f"{database}.t"))
    catalog.refresh(spark, f"{database}.t")
    try:
        catalog.use_database(spark, database)
        assert spark.table("t").count() == 2
    finally:
        catalog.use_database(spark, before)


def test_full_load_is_repeatable(spark, sf_dir, tmp_path, database):
    lake = Lakehouse(str(tmp_path / "lake"), database, KEY_TYPE)
    read = raw_tables(spark, sf_dir).__getitem__
    first = run_full_load(spark, read, lake)
    again = run_full_load(spark, read, lake)
    assert first == again
    assert {name.split("/")[0] for name in first} == {"bronze", "silver", "gold"}
    assert len(first) == 21
    tables = catalog.table_contents(spark, database)
    assert len(tables) == 14
    assert all(n == tables[k.split("/")[1]].count() for k, n in first.items() if "gold" in k)
    for table, df in read_catalog(spark, database).items():
        fields = silver_schema(table, KEY_TYPE)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in fields]


def test_a_load_without_rows_fails(spark, sf_dir, tmp_path):
    lake = Lakehouse(str(tmp_path / "lake"), "unused")
    empty = {t: df.limit(0) for t, df in raw_tables(spark, sf_dir).items()}
    with pytest.raises(MissingOutput, match="bronze/orders"):
        run_full_load(spark, empty.__getitem__, lake)


def test_layers_read_back(spark, sf_dir, tmp_path):
    lake = Lakehouse(str(tmp_path / "lake"), f"db_{tmp_path.name.replace('-', '_')}", KEY_TYPE)
    bronze = load_bronze(raw_tables(spark, sf_dir).__getitem__, lake)
    silver = build_silver(spark, lake)
    for layer, counts in {"bronze": bronze, "silver": silver}.items():
        found = read_layer(spark, lake.layer(layer))
        assert set(found) == set(TABLES)
        assert {t: df.count() for t, df in found.items()} == counts
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")


class Settings:
    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    @property
    def conf(self):
        return self

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_scratch_follows_the_session():
    shared = Settings(spark_checkpoint_dir="hdfs://data/scratch/", spark_master="yarn")
    assert scratch_root(shared) == "hdfs://data/scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Settings(spark_master="yarn"))
    assert scratch_root(Settings(spark_master="local[2]")) == tempfile.gettempdir()


def test_scratch_folders_are_new(spark):
    assert new_scratch(spark, "x") != new_scratch(spark, "x")
