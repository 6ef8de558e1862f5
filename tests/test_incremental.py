"""Incremental releases: touched months alone are written, a crash leaves the old rows, old files go."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from lodestar.operators.upsert import upsert_partitioned
from lodestar.plans.pipeline import MONTH, run_pipeline
from lodestar.plans.star import read_release
from lodestar.sources import store
from lodestar.sources.tables import bronze_tables

from .conftest import SF001

KEYS = ["order_id", "order_item_id"]
SCHEMA = "order_id string, order_item_id int, month int, amount int"


def fresh():
    return f"inc_{uuid.uuid4().hex[:12]}"


def files_by_month(spark, name):
    found = store.Releases(spark, name).read("fact_sales").select(MONTH, F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in found:
        out.setdefault(r[MONTH], set()).add(r.f)
    return out


def on_disk(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_month_run_writes_one_month_and_old_releases_go(spark, scratch):
    name, bronze = fresh(), bronze_tables(spark, SF001, renumber=True)
    bronze["order_items"] = store.stage(bronze["order_items"], "items")
    run_pipeline(spark, bronze, name, scratch)
    first, rows = files_by_month(spark, name), read_release(spark, name).fact.count()
    month = sorted(first)[3]
    orders = bronze["orders"].where(F.date_format(F.to_timestamp("order_purchase_timestamp"), "yyyyMM").cast("int") == month).select("order_id")
    part = {**bronze, "order_items": bronze["order_items"].join(orders, "order_id", "left_semi")}
    second_run = run_pipeline(spark, part, name, scratch)
    assert second_run.months == [month]
    second = files_by_month(spark, name)
    assert {m for m in second if second[m] != first[m]} == {month} and not second[month] & first[month]
    assert read_release(spark, name).fact.count() == rows and read_release(spark, name).fact.columns == first_columns(spark, name)
    third_run = run_pipeline(spark, part, name, scratch)  # keep=2: the first release goes, but not the files that the others use
    assert third_run.published and store.Releases(spark, name).current() == 3
    assert not store.exists(spark, f"{name}__fact_sales__r1") and not store.exists(spark, f"{name}__dim_date__r1")
    assert read_release(spark, name).fact.count() == rows
    left = {f.replace("file:", "").replace("///", "/") for own in files_by_month(spark, name).values() for f in own}
    assert left <= on_disk(scratch)
    assert not {f.replace("file:", "").replace("///", "/") for f in first[month]} & on_disk(scratch)


def first_columns(spark, name):
    return [c for c in store.Releases(spark, name).read("fact_sales").columns if c != MONTH]


@pytest.mark.parametrize("step", ["write_next", "swap", "second rename"])
def test_a_crash_leaves_the_old_rows(spark, scratch, monkeypatch, step):
    name = fresh()
    old = [("o1", 1, 1, 10), ("o2", 1, 2, 20), ("o3", 1, 3, 30)]
    upsert_partitioned(spark.createDataFrame(old, SCHEMA), name, KEYS, "month", scratch)
    moved = spark.createDataFrame([("o1", 1, 2, 11)], SCHEMA)

    def crash(*_, **__):
        raise OSError("executor store gone")

    with monkeypatch.context() as m:
        if step == "second rename":
            from pyspark.sql import SparkSession
            sql = SparkSession.sql

            def failing(self, text, *a, **b):
                if "RENAME TO" in text and text.endswith(f"RENAME TO {name}"):
                    crash()
                return sql(self, text, *a, **b)

            m.setattr(type(spark), "sql", failing)
        else:
            m.setattr(store, step, crash)
        with pytest.raises(OSError):
            upsert_partitioned(moved, name, KEYS, "month")
    store.restore(spark, name)
    columns = ["order_id", "order_item_id", "month", "amount"]
    assert sorted(tuple(r) for r in spark.table(name).select(columns).collect()) == old
    out = upsert_partitioned(moved, name, KEYS, "month").select(columns)
    assert sorted(tuple(r) for r in out.collect()) == [("o1", 1, 2, 11), *old[1:]]
    assert spark.sql(f"SHOW TABLES LIKE '{name}__before'").count() == 0


def test_staged_copies_go_with_the_run(spark):
    with store.Staging(spark, "t") as staging:
        assert staging.put(spark.range(3), "a").count() == 3
        root = staging.root.replace("file:", "")
        assert on_disk(root)
    assert not os.path.exists(root)
