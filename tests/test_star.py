"""Fact, keys, calendar and customer-link modes."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from lodestar.functions.keys import date_key, surrogate_key
from lodestar.operators import cleaning, dims
from lodestar.operators.fact import build_fact


def _fixture_f2(spark):
    customers = spark.createDataFrame([("c1", "u1", "x"), ("c2", "u1", "x"), ("c3", "u2", "y")],
                                      "customer_id string, customer_unique_id string, customer_city string")
    orders = spark.createDataFrame([("o1", "c1", "2018-01-01 00:00:00"), ("o2", "c2", "2018-01-02 00:00:00"),
                                    ("o3", "c3", "2018-01-03 00:00:00")],
                                   "order_id string, customer_id string, order_purchase_timestamp string")
    d = Decimal
    items = spark.createDataFrame([("o1", 1, "p1", d("10"), d("1")), ("o2", 1, "p1", d("20"), d("2")),
                                   ("o3", 1, "p2", d("30"), d("3"))],
                                  "order_id string, order_item_id int, product_id string, "
                                  "price decimal(18,2), freight_value decimal(18,4)")
    return customers, orders, items


def test_surrogate_key_is_sha256_hex(spark):
    row = spark.createDataFrame([("abc",), (None,)], "k string").select(surrogate_key("k").alias("h")).collect()
    assert row[0]["h"] == hashlib.sha256(b"abc").hexdigest()
    assert row[1]["h"] is None


def test_date_key(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 3, 7, 23, 59),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(date_key("t")).collect()] == [20190307, None]


def test_customer_link_modes(spark):
    # Dedup keeps c1 for u1, so o2 (c2) drops in parity mode, not in all_ids.
    customers, orders, items = _fixture_f2(spark)
    sc = cleaning.clean_customers(customers)
    so = cleaning.clean_orders(orders)
    deduped = build_fact(so, sc, items)
    all_ids = build_fact(so, sc, items, customer_link="all_ids", bronze_customers=customers)
    assert sorted(r["order_id"] for r in deduped.collect()) == ["o1", "o3"]
    assert sorted(r["order_id"] for r in all_ids.collect()) == ["o1", "o2", "o3"]
    u1 = hashlib.sha256(b"u1").hexdigest()
    assert {r["customer_sk"] for r in all_ids.where(F.col("order_id").isin("o1", "o2")).collect()} == {u1}


def test_calendar_default_bounds(spark):
    d = dims.dim_date(spark)
    assert d.count() == 1827
    first = d.orderBy("date_sk").first()
    assert first["date_sk"] == 20160101 and first["day_name"] == "Friday"
    assert first["calendar_quarter"] == 1


def test_calendar_covering(spark):
    df = spark.createDataFrame([(dt.datetime(1995, 6, 1),), (dt.datetime(1996, 2, 1),)], "t timestamp_ntz")
    d = dims.dim_date_covering(df, "t")
    assert d.count() == 365 + 366
    assert d.agg(F.min("date_sk"), F.max("date_sk")).first() == (19950101, 19961231)


def test_dim_key_first(spark):
    df = spark.createDataFrame([("p1", "cat")], "product_id string, product_category_name string")
    assert dims.dim_product(df).columns[0] == "product_sk"
