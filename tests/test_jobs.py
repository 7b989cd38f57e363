"""The command line, on sample tables in place of a database."""

from __future__ import annotations

import json

import pytest

from orderloom import catalog, jobs
from orderloom.checks.queries import _order_events
from orderloom.plans.runs import Lakehouse, load_bronze
from orderloom.sinks.layers import replace_parquet
from orderloom.sources.relational import RangeSplit
from orderloom.sources.sample_tables import raw_tables


def test_arguments_are_checked(capsys):
    for missing in (["full-load"], ["ingest"], ["nothing"], ["publish", "--segments"]):
        with pytest.raises(SystemExit):
            jobs.arguments([*missing, "--root", "r", "--database", "d"])
    told = capsys.readouterr().err
    assert "--jdbc-url" in told and "--segments is for" in told


def test_split():
    assert jobs.split_of("orders=order_id:64") == ("orders", RangeSplit("order_id", 64))


@pytest.fixture
def job(spark, tmp_path):
    database = f"db_{tmp_path.name.replace('-', '_')}"
    lake = Lakehouse(str(tmp_path / "lake"), database, "bigint")

    def run(name, *more):
        fixed = ["--root", lake.root, "--database", database, "--key-type", "bigint"]
        jobs.run(spark, jobs.arguments([name, *fixed, *more]))

    run.lake = lake
    yield run
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_silver_and_gold(spark, sf_dir, job):
    load_bronze(raw_tables(spark, sf_dir).__getitem__, job.lake)
    job("silver")
    job("gold")
    tables = catalog.list_tables(spark, job.lake.database)
    assert len(tables) == 14
    kpi = spark.table(f"{job.lake.database}.report_kpi_summary").collect()
    assert len(kpi) == 1
    job("gold", "--buckets", "4")
    assert spark.table(f"{job.lake.database}.report_kpi_summary").collect() == kpi
    dealt = spark.table(f"{job.lake.database}.orders_by_order").count()
    assert dealt == spark.table(f"{job.lake.database}.silver_orders").count()


def test_stream_jobs_one_by_one_and_together(spark, sf_dir, job, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    events = _order_events(spark, sf_dir)
    n_events = replace_parquet(events, arrivals)
    options = tmp_path / "options.json"
    options.write_text(json.dumps({"maxFilesPerTrigger": "1"}))
    source = ["--events-folder", arrivals, "--options-file", str(options)]
    job("ingest", *source)
    job("refine", "--max-files", "2")
    job("publish")
    assert spark.table(job.lake.stream_table).count() == n_events
    job("incremental", *source)
    assert spark.table(job.lake.stream_table).count() == n_events


def test_segments_together_and_refined_alone(spark, sf_dir, job, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    n_events = replace_parquet(_order_events(spark, sf_dir), arrivals)
    source = ["--events-folder", arrivals]
    for _ in range(2):
        job("incremental", "--segments", "--max-files", "4", *source)
        assert spark.table(job.lake.segments.name).count() == n_events
    job("refine", "--segments")
    assert spark.table(job.lake.segments.name).count() == n_events
