"""Views from monthly states equal the views over the lines, release after release."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from lodestar.operators import dims
from lodestar.operators.upsert import as_text
from lodestar.plans import rollups, views
from lodestar.plans.pipeline import MONTH, run_pipeline
from lodestar.plans.star import read_release
from lodestar.sources import store
from lodestar.sources.tables import bronze_tables

from .conftest import SF001

SCHEMA = ("order_id string, order_item_id int, customer_sk string, product_sk string, order_date_sk int, "
          "sales_amount decimal(18,2), freight_value decimal(18,4)")
LINES = """SELECT * FROM VALUES
 ('a', 1, 'c1', 'p1', 20200105, 900.50, 10.0), ('a', 2, 'c1', 'p2', 20200105, 700.25, 1.5),
 ('b', 1, 'c2', 'p1', 20200220, 600.00, 2.0), ('c', 1, 'c1', 'p1', 20200229, 50.00, 2.0),
 ('d', 1, null, 'p2', 20200301, 800.00, 2.0), (null, 1, 'c3', 'p2', 20200301, 75.00, 2.0),
 ('e', 1, 'c4', null, null, 60.00, 3.0), ('e', null, 'c4', 'p1', 20210101, null, null)"""


def lines(spark, sql=LINES):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = spark.sql(sql).toDF(*names)
    typed = rows.select(*[F.col(c.split(" ", 1)[0]).cast(c.split(" ", 1)[1]) for c in SCHEMA.split(", ")])
    return typed.withColumn(MONTH, F.floor(F.col("order_date_sk") / 100).cast("int"))


def releases_of(spark, scratch):
    return store.Releases(spark, f"roll_{uuid.uuid4().hex[:12]}", scratch)


def same(left, right):
    key = lambda r: str(r)
    assert left.columns == right.columns
    assert sorted(map(tuple, left.collect()), key=key) == sorted(map(tuple, right.collect()), key=key)


def all_equal(spark, reports, fact, dates, products):
    same(reports.executive_kpis(), views.executive_kpis(fact))
    same(reports.monthly_sales(dates), views.monthly_sales(fact, dates))
    same(reports.yoy_growth(dates), views.yoy_growth(fact, dates))
    same(reports.customer_ltv(), views.customer_ltv(fact))
    same(reports.category_freight(products), views.category_freight(fact, products))


def products(spark):
    return spark.createDataFrame([("p1", "toys"), ("p2", "books")], "product_sk string, product_category_name string")


def test_two_releases_equal_the_lines(spark, scratch):
    releases, dates = releases_of(spark, scratch), dims.dim_date(spark, "2020-01-01", "2021-12-31")
    first = releases.save_partitioned(lines(spark), "fact_sales", 1, MONTH)
    rollups.refresh(releases, 1, None, [], MONTH)
    all_equal(spark, rollups.Reports(releases, MONTH, 1), first.drop(MONTH), dates, products(spark))

    # Line 2 of order a moves to February, where a new customer comes; March loses all its lines.
    months = [202001, 202002, 202003]
    changed = lines(spark, """SELECT * FROM VALUES
     ('a', 1, 'c1', 'p1', 20200105, 900.50, 10.0), ('a', 2, 'c1', 'p2', 20200206, 700.25, 1.5),
     ('b', 1, 'c2', 'p1', 20200220, 600.00, 2.0), ('f', 1, 'c9', 'p2', 20200221, 5.00, 2.0)""")
    second = releases.save_partitioned(changed, "fact_sales", 2, MONTH, 1, as_text(months))
    rollups.refresh(releases, 2, 1, months, MONTH)
    reports = rollups.Reports(releases, MONTH, 2)
    all_equal(spark, reports, second.drop(MONTH), dates, products(spark))
    # Order e has a line without date as well, so it counts for two months too.
    assert sorted(map(tuple, releases.read("split_orders", 2).collect())) == [("c1", 1), ("c4", 1)]
    # Kept numbers stay, months that did not change point at the first release's files.
    old = {r.key: r.number for r in releases.read("numbers_orders", 1).collect()}
    new = {r.key: (r.number, r.given) for r in releases.read("numbers_orders", 2).collect()}
    assert {k: (n, 1) for k, n in old.items()}.items() <= new.items() and new["f"][1] == 2
    for table in ("by_day", "by_product", "by_customer", "bitmaps"):
        files = releases.read(table, 2).select(MONTH, F.col("_metadata.file_path").alias("f")).distinct().collect()
        assert {r[MONTH] for r in files if f"{table}__r2" in r.f} == {202001, 202002}
        assert 202101 in {r[MONTH] for r in files if f"{table}__r1" in r.f}


def test_empty_fact(spark, scratch):
    releases = releases_of(spark, scratch)
    fact = releases.save_partitioned(lines(spark).where("false"), "fact_sales", 1, MONTH)
    rollups.refresh(releases, 1, None, [], MONTH)
    all_equal(spark, rollups.Reports(releases, MONTH, 1), fact.drop(MONTH), dims.dim_date(spark, "2020-01-01", "2020-12-31"), products(spark))


def test_calendar_that_cuts_a_month_is_refused(spark, scratch):
    releases = releases_of(spark, scratch)
    fact = releases.save_partitioned(lines(spark), "fact_sales", 1, MONTH).drop(MONTH)
    rollups.refresh(releases, 1, None, [], MONTH)
    reports = rollups.Reports(releases, MONTH, 1)
    outside = dims.dim_date(spark, "2020-01-01", "2020-01-31")  # the other months are left out whole
    same(reports.monthly_sales(outside), views.monthly_sales(fact, outside))
    with pytest.raises(Exception, match="cuts a month"):
        reports.monthly_sales(dims.dim_date(spark, "2020-01-01", "2020-02-25")).collect()


def test_numbers_of_many_buckets(spark, scratch):
    releases = releases_of(spark, scratch)
    many = spark.range(100_000).select(
        F.col("id").cast("string").alias("order_id"), F.lit(1).alias("order_item_id"), (F.col("id") % 40_000).cast("string").alias("customer_sk"),
        F.lit("p1").alias("product_sk"), F.when(F.col("id") % 3 == 0, 20200105).otherwise(20200401).alias("order_date_sk"),
        F.lit(1).cast("decimal(18,2)").alias("sales_amount"), F.lit(1).cast("decimal(18,4)").alias("freight_value"))
    releases.save_partitioned(many.withColumn(MONTH, F.floor(F.col("order_date_sk") / 100).cast("int")), "fact_sales", 1, MONTH)
    rollups.refresh(releases, 1, None, [], MONTH)
    assert rollups.Reports(releases, MONTH, 1).executive_kpis().first()[:2] == (100_000, 40_000)
    # Orders lie in one month each and are numbered by month: hardly a bitmap holds two months.
    bits = releases.read("bitmaps", 1).where("kind = 'orders'")
    assert bits.groupBy("given", "bucket").count().where("count > 1").count() <= 1


def test_pipeline_refreshes_the_reports(spark, scratch):
    name, bronze = f"roll_{uuid.uuid4().hex[:12]}", bronze_tables(spark, SF001, renumber=True)
    bronze["order_items"] = store.stage(bronze["order_items"], "items")
    run_pipeline(spark, bronze, name, scratch, reports=True)
    orders = bronze["orders"].where(F.col("order_purchase_timestamp").startswith("1997-03")).select("order_id")
    part = {**bronze, "order_items": bronze["order_items"].join(orders, "order_id", "left_semi").withColumn(
        "price", (F.col("price") * 2).cast("decimal(18,2)"))}
    run_pipeline(spark, part, name, scratch, reports=True)
    star = read_release(spark, name)
    reports = rollups.Reports(store.Releases(spark, name, scratch), MONTH)
    all_equal(spark, reports, star.fact, star.dim_date, star.dim_product)
    written = [f for _, _, fs in os.walk(os.path.join(scratch, f"{name}__by_day__r2")) for f in fs if f.endswith(".parquet")]
    assert len(written) == 1
