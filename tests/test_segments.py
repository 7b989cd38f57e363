"""Refinement into segments: known ids, folds, failed runs."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.streaming import segments as sg
from orderloom.streaming.ingest import landing_schema


@pytest.fixture
def store(spark, tmp_path):
    database = f"seg_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/warehouse'")
    yield sg.SegmentTable(f"{database}.orders", f"{tmp_path}/store", fan=3)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def land(spark, folder, ids, accepted=True, rows_per_file=0):
    """One landed file with these ids, or as many as they fill."""
    rows = spark.createDataFrame([(i,) for i in ids], "order_id int").coalesce(1)
    for f in landing_schema():
        if f.name != "order_id":
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    rows = rows.withColumns({"accepted": F.lit(accepted), "customer_id": F.lit(" acme ")})
    rows.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("accepted").parquet(folder)


def ids_of(spark, store):
    return sorted(r[0] for r in spark.table(store.name).select("order_id").collect())


def files_of(store, kind="rows"):
    return len(list(Path(store.root, kind).rglob("*.parquet")))


def test_ids_are_kept_once_within_and_across_runs(spark, store, tmp_path):
    landing = f"{tmp_path}/landing"
    land(spark, landing, [1, 2, 2, 3])
    assert sg.refine_new(spark, landing, store) == 3
    land(spark, landing, [3, 1, 4])
    land(spark, landing, [4, 5])
    assert sg.refine_new(spark, landing, store) == 2
    assert sg.refine_new(spark, landing, store) == 0
    assert ids_of(spark, store) == [1, 2, 3, 4, 5]
    assert {r[0] for r in spark.table(store.name).select("customer_id").collect()} == {"ACME"}


def test_rejects_and_runs_without_new_ids(spark, store, tmp_path):
    landing = f"{tmp_path}/landing"
    land(spark, landing, [None], accepted=False)
    assert sg.refine_new(spark, landing, store) == 0
    land(spark, landing, [])
    land(spark, landing, [7])
    assert sg.refine_new(spark, landing, store) == 1
    land(spark, landing, [7])
    assert sg.refine_new(spark, landing, store) == 0
    assert sg.refine_new(spark, landing, store) == 0
    assert ids_of(spark, store) == [7]


def test_ids_too_many_to_be_sent_to_all_tasks(spark, store, tmp_path):
    narrow = sg.SegmentTable(store.name, store.root, fan=3, broadcast_bytes=0)
    landing = f"{tmp_path}/landing"
    land(spark, landing, range(0, 200))
    sg.refine_new(spark, landing, narrow)
    land(spark, landing, range(100, 300))
    assert sg.refine_new(spark, landing, narrow) == 100
    assert ids_of(spark, store) == list(range(300))


def test_files_are_bounded_over_fifty_lots(spark, store, tmp_path):
    """Each lot repeats half of the one before; the rows are those of all lots."""
    landing = f"{tmp_path}/landing"
    lots = [i for n in range(50) for i in range(n * 5, n * 5 + 10)]
    land(spark, landing, lots, rows_per_file=10)
    assert sg.refine_new(spark, landing, store, max_files=1) == 255
    assert ids_of(spark, store) == list(range(255))
    live = sg.live_segments(spark, store)
    # Fewer than fan in each of log(50) tiers; 50 = 1212 to the base of 3.
    assert sorted(s.split("-")[0] for s in live) == ["0", "0", "1", "2", "2", "3"]
    # Live ones and those of the last fold.
    assert files_of(store) <= 2 * 6
    assert files_of(store, "sources") <= 2 * 6
    assert sg.covered_files(spark, store).count() == 50


def test_folded_segments_are_sorted_and_history_is_pruned(spark, store, tmp_path):
    landing = f"{tmp_path}/landing"
    for ids in ([5, 1], [4, 2], [3]):
        land(spark, landing, ids)
    sg.refine_new(spark, landing, store, max_files=1)
    (segment,) = sg.live_segments(spark, store)
    assert [r[0] for r in spark.read.parquet(store.folder(segment)).select("order_id").collect()] == [1, 2, 3, 4, 5]
    asked = spark.createDataFrame([(2,), (9,)], "order_id int")
    known = sg.known_ids(spark, store, asked)
    plan = known._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(order_id,2)" in plan and "LessThanOrEqual(order_id,9)" in plan
    assert "ReadSchema: struct<order_id:int>" in plan
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert [r[0] for r in known.collect()] == [2]


@pytest.mark.parametrize("step", ["_write", "_show"])
def test_a_failed_run_shows_nothing_and_is_made_up_for(spark, store, tmp_path, monkeypatch, step):
    landing = f"{tmp_path}/landing"
    land(spark, landing, [1, 2])
    sg.refine_new(spark, landing, store)
    land(spark, landing, [2, 3])
    real = getattr(sg, step)

    def fails(*args):
        if step == "_write":
            real(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sg, step, fails)
    with pytest.raises(RuntimeError):
        sg.refine_new(spark, landing, store)
    assert ids_of(spark, store) == [1, 2]
    monkeypatch.setattr(sg, step, real)
    assert sg.refine_new(spark, landing, store) == 1
    assert ids_of(spark, store) == [1, 2, 3]


def test_a_failed_fold_leaves_the_segments(spark, store, tmp_path, monkeypatch):
    landing = f"{tmp_path}/landing"
    for n in range(2):
        land(spark, landing, [n])
        sg.refine_new(spark, landing, store)
    real = sg._write
    land(spark, landing, [2])

    def fails(spark, table, segment, *rest):
        if segment.startswith("1-"):
            raise RuntimeError("driver lost")
        return real(spark, table, segment, *rest)

    monkeypatch.setattr(sg, "_write", fails)
    with pytest.raises(RuntimeError):
        sg.refine_new(spark, landing, store)
    assert ids_of(spark, store) == [0, 1, 2]
    monkeypatch.setattr(sg, "_write", real)
    assert sg.fold_segments(spark, store) == 3
    assert ids_of(spark, store) == [0, 1, 2]
    assert len(sg.live_segments(spark, store)) == 1
