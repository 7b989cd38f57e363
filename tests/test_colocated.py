"""Reports over lines and headers that lie together by order id."""

from __future__ import annotations

from dataclasses import replace

import pytest
from test_star import POLICIES, expected, rows_of, tables  # noqa: F401

from orderloom.operators.skew import KeyLoads
from orderloom.operators.star import order_totals, product_totals
from orderloom.plans import colocated as co
from orderloom.plans.gold import REPORTS
from orderloom.sources.sample_tables import retail_tables


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("colocated")
    name = folder.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def dealt(spark, tables, database):  # noqa: F811
    return co.deal_by_order(spark, tables, database, 4, POLICIES["heavy"])


def test_every_row_is_in_one_part(spark, tables, database, dealt):  # noqa: F811
    assert dealt["order_details_heavy"] > 0 and dealt["order_details_dealt"] > 0
    for table in co.FACTS:
        found = spark.table(f"{database}.{table}_by_order")
        assert rows_of(found) == rows_of(tables[table])
        assert dealt[f"{table}_dealt"] + dealt[f"{table}_heavy"] == tables[table].count()
        parts = (spark.table(f"{database}.{table}_{kind}").select("order_id") for kind in ("dealt", "heavy"))
        light, heavy = ({r[0] for r in part.collect()} for part in parts)
        assert 0 in heavy and not light & heavy


@pytest.mark.parametrize("name", REPORTS)
def test_report_equals_plain_grouping(spark, tables, expected, database, dealt, name):  # noqa: F811
    totals = co.colocated_totals(spark, database, tables, POLICIES["heavy"])
    found = REPORTS[name](totals, ordered=False)
    assert (sorted(found.columns), rows_of(found)) == expected[name]


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_no_exchange_below_the_order_join(spark, sf_dir, tmp_path, no_broadcast):
    retail = retail_tables(spark, sf_dir)
    name = f"even_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    counts = co.deal_by_order(spark, retail, name, 8)
    assert counts["order_details_heavy"] == counts["orders_heavy"] == 0
    star = co.colocated_totals(spark, name, retail).star
    even = {t: spark.table(f"{name}.{t}_dealt") for t in co.FACTS}
    star = replace(star, **even, order_loads=KeyLoads(), line_loads=KeyLoads())
    plan = _plan(order_totals(star))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Exchange" not in plan and "Bucketed: true" in plan
    # Products are grouped after the join, by their own id.
    plan = _plan(product_totals(star))
    assert "hashpartitioning(order_id" not in plan and "hashpartitioning(product_id" in plan
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_dealing_again_swaps_and_clears(spark, tables, database, dealt):  # noqa: F811
    before = spark.table(f"{database}.orders_dealt")
    less = {t: tables[t].where("order_id is null or order_id <> 3") for t in co.FACTS}
    rows = before.count()
    for _ in range(3):
        co.deal_by_order(spark, less, database, 4, POLICIES["heavy"])
    found = spark.table(f"{database}.orders_by_order")
    assert rows_of(found) == rows_of(less["orders"])
    assert rows == dealt["orders_dealt"]
    # The newest version and the one before, of four tables each.
    assert len(co._versions(spark, database)) == 8


def test_a_failure_leaves_the_tables_as_they_were(spark, tables, database, dealt, monkeypatch):  # noqa: F811
    before = rows_of(spark.table(f"{database}.orders_by_order"))
    real = co._save

    def fails(rows, name, buckets):
        if "orders_heavy" in name:
            raise RuntimeError("driver lost")
        return real(rows, name, buckets)

    monkeypatch.setattr(co, "_save", fails)
    with pytest.raises(RuntimeError):
        co.deal_by_order(spark, {t: tables[t].limit(0) for t in co.FACTS}, database, 4)
    assert rows_of(spark.table(f"{database}.orders_by_order")) == before


def test_empty_tables(spark, tables, tmp_path):  # noqa: F811
    name = f"empty_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    none = {t: tables[t].limit(0) for t in co.FACTS}
    assert set(co.deal_by_order(spark, none, name, 4).values()) == {0}
    totals = co.colocated_totals(spark, name, tables)
    assert totals.by_order.count() == 0
    assert tuple(REPORTS["report_kpi_summary"](totals).first()) == (None, 0, 0, 0, 0)
    spark.sql(f"DROP DATABASE {name} CASCADE")
