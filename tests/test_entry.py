"""Driver contract: entry, registry and oracle keys; pipeline on sf0.001."""

import uuid

import duckdb
import pytest

import __spark_entry__ as E
from lodestar.operators.quality import QualityGateError
from lodestar.plans.pipeline import run_pipeline
from lodestar.sources.store import Releases
from lodestar.sources.tables import TABLES, bronze_tables
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sales_year", "sales_month", "total_orders", "total_items_sold",
                          "total_revenue", "total_freight_cost"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_small_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    sqls = E.oracle_sql()
    for name in ["monthly_sales", "customer_ltv", "category_freight", "dq_ledger", "executive_kpis"]:
        s = sorted(tuple(r) for r in E.queries()[name](spark, SF001).collect())
        d = sorted(tuple(r) for r in con.execute(f"SELECT * FROM ({sqls[name]}) q").fetchall())
        cols = E.queries()[name](spark, SF001).columns
        dcols = [c[0] for c in con.execute(f"SELECT * FROM ({sqls[name]}) q LIMIT 0").description]
        assert cols == dcols, name
        assert s == d, name


def test_pipeline_publishes_after_gate(spark, scratch):
    name = f"wh_{uuid.uuid4().hex[:12]}"
    bronze = bronze_tables(spark, SF001, renumber=True)
    res = run_pipeline(spark, bronze, name, scratch, cluster=False)
    assert res.published and res.release == 1
    assert all(r["status"] == "PASS" for r in res.ledger.collect())
    releases = Releases(spark, name)
    rows = releases.read("fact_sales").count()
    # Second run upserts into the published fact: same rows, clustered this time.
    res2 = run_pipeline(spark, bronze, name, scratch)
    assert res2.release == 2 == releases.current() and releases.read("fact_sales").count() == rows


def test_failed_gate_publishes_nothing(spark, scratch):
    name = f"wh_{uuid.uuid4().hex[:12]}"
    bronze = bronze_tables(spark, SF001, renumber=True)
    run_pipeline(spark, bronze, name, scratch, cluster=False)
    # A calendar that misses most order dates: the date check fails.
    part = ("1996-01-01", "1996-12-31")
    with pytest.raises(QualityGateError):
        run_pipeline(spark, bronze, name, scratch, cluster=False, calendar=part)
    assert not run_pipeline(spark, bronze, name, scratch, cluster=False, calendar=part, enforce=False).published
    assert Releases(spark, name).current() == 1
    audit = spark.table(f"{name}__audit_log")
    assert audit.where("status = 'FAIL' AND column_checked = 'order_date_sk'").count() == 2
