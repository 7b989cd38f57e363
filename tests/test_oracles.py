"""Every registered query against its SQL, over the whole sample tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as driver
from orderloom.checks import queries
from orderloom.checks.oracles import ORACLES
from orderloom.checks.queries import QUERIES
from orderloom.plans.runs import write_totals
from orderloom.sources.sample_tables import raw_tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SQL_TYPES = {
    "STRING": "VARCHAR",
    "INT": "INTEGER",
    "BIGINT": "BIGINT",
    "DOUBLE": "DOUBLE",
    "DATE": "DATE",
    "BOOLEAN": "BOOLEAN",
    "TIMESTAMP_NTZ": "TIMESTAMP",
}


@pytest.fixture(scope="session")
def sql(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield con
    con.close()


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([_value(r[i]) for i in order] for r in rows)


def _kind(spark_type: str) -> str:
    name = spark_type.upper()
    return "DECIMAL" if name.startswith("DECIMAL") else SQL_TYPES.get(name, name)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, sf_dir, name):
    settings = dict(spark.conf.getAll)
    database = spark.catalog.currentDatabase()
    df = driver.queries()[name](spark, sf_dir)
    result = sql.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).split("(")[0] for d in result.description}
    expected = _rows(columns, result.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]
    assert {f: _kind(t) for f, t in df.dtypes} == kinds
    assert spark.catalog.currentDatabase() == database
    assert settings == dict(spark.conf.getAll)


def test_entry(spark):
    assert driver.entry(spark).count() == 10


def test_the_bronze_load_returns_every_row_it_wrote(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    found = QUERIES["full_load_bronze"](spark, sf_dir)
    counts = {r["table_name"]: r["count"] for r in found.groupBy("table_name").count().collect()}
    assert counts == {t: df.count() for t, df in raw.items()}
    lines = found.where("table_name = 'order_details'").select(raw["order_details"].columns)
    assert lines.exceptAll(raw["order_details"]).isEmpty()


def test_reports_on_cleaned_tables_clean_lines_once(spark, sf_dir, monkeypatch):
    """What a report counts, profiles and reads are files, not the cleaning plan over and over."""
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    for name in ("silver_report_kpi_summary", "silver_report_top_products", "silver_report_top_customers"):
        assert "RLIKE" not in plan(QUERIES[name](spark, sf_dir))
    seen = []
    monkeypatch.setattr(queries, "write_totals", lambda s, plan: seen.append(plan) or write_totals(s, plan))
    QUERIES["colocated_reports"](spark, sf_dir)
    assert len(seen) == 1
