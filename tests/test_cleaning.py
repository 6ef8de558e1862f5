"""Silver cleaning traps (FIXTURES F1, F3, F4, F5)."""

import datetime as dt

from lodestar.operators import cleaning


def test_drop_null_keys_any(spark):
    # first null, second null, both null, none null -> one survivor.
    df = spark.createDataFrame([(None, "b"), ("a", None), (None, None), ("a", "b")], "x string, y string")
    assert cleaning.drop_null_keys(df, ["x", "y"]).count() == 1


def test_dedup_keeps_smallest_customer_id(spark):
    # Deterministic survivor per person.
    df = spark.createDataFrame([("c2", "u1", " X "), ("c1", "u1", "Y"), ("c3", "u2", "Z")],
                               "customer_id string, customer_unique_id string, customer_city string")
    out = {r["customer_unique_id"]: r for r in cleaning.clean_customers(df).collect()}
    assert out["u1"]["customer_id"] == "c1"
    assert out["u1"]["customer_city"] == "y"
    assert out["u2"]["customer_id"] == "c3"


def test_city_normalised(spark):
    # "  Sao PAULO " -> "sao paulo".
    df = spark.createDataFrame([("c1", "u1", "  Sao PAULO ")],
                               "customer_id string, customer_unique_id string, customer_city string")
    assert cleaning.clean_customers(df).collect()[0]["customer_city"] == "sao paulo"


def test_timestamps_parse_or_null(spark):
    # A value, malformed text and null; ANSI mode stays on.
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("o1", "c1", "2018-05-01 10:00:00"), ("o2", "c1", "not a date"),
                                ("o3", "c1", None)],
                               "order_id string, customer_id string, order_purchase_timestamp string")
    out = {r["order_id"]: r["order_purchase_timestamp"] for r in cleaning.clean_orders(df).collect()}
    assert out == {"o1": dt.datetime(2018, 5, 1, 10, 0), "o2": None, "o3": None}
    nulled = cleaning.unparsed_timestamps(df).collect()[0]
    assert nulled["order_purchase_timestamp_nulled"] == 1


def test_translation_unknown_and_no_fanout(spark):
    # A translated, null and unmatched -> unknown; a duplicated lookup row
    # must not duplicate products.
    products = spark.createDataFrame([("p1", "a"), ("p2", None), ("p3", "zz")],
                                     "product_id string, product_category_name string")
    lookup = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B")],
                                   "product_category_name string, product_category_name_english string")
    out = {r["product_id"]: r["product_category_name"]
           for r in cleaning.localize_products(products, lookup).collect()}
    assert out == {"p1": "A", "p2": "unknown", "p3": "unknown"}
    assert cleaning.localize_products(products, lookup).count() == 3


def test_stamp_columns_not_duplicated(spark):
    # Both inputs carry _load_timestamp; the result has each column once.
    products = spark.createDataFrame([("p1", "a", dt.datetime(2020, 1, 1))],
                                     "product_id string, product_category_name string, _load_timestamp timestamp")
    lookup = spark.createDataFrame([("a", "A", dt.datetime(2020, 1, 2))],
                                   "product_category_name string, product_category_name_english string, "
                                   "_load_timestamp timestamp")
    out = cleaning.localize_products(products, lookup)
    assert len(out.columns) == len(set(out.columns))
    assert out.collect()[0]["_load_timestamp"] == dt.datetime(2020, 1, 1)


def test_items_null_keys(spark):
    df = spark.createDataFrame([("o1", 1, "p1"), ("o1", None, "p1"), (None, 2, "p2")],
                               "order_id string, order_item_id int, product_id string")
    assert cleaning.clean_items(df).count() == 1
