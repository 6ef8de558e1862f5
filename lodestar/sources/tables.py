"""Reading the driver's parquet tables and mapping them onto retail roles.

The test tables are TPC-H-shaped; the library works on the retail roles
(orders, order items, customers, products, category translation).  The
mapping is a plain projection per table, so the scans keep column pruning
and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.money import MONEY, MONEY_PRODUCT
from lodestar.operators.ranking import number_within_groups

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Category translation rows for the test data (4 of the 6 part
# types have an English name; the other two become 'unknown').
CATEGORY_TRANSLATION_ROWS = [
    ("STANDARD", "standard"),
    ("LARGE", "large"),
    ("SMALL", "small"),
    ("MEDIUM", "medium"),
]


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def bronze_orders(spark: SparkSession, base: str) -> DataFrame:
    # Null keys go before the cast to text, so that the filter reaches the scan.
    o = read_table(spark, base, "orders").dropna(subset=["o_orderkey", "o_custkey"])
    return o.select(
        o.o_orderkey.cast("string").alias("order_id"),
        o.o_custkey.cast("string").alias("customer_id"),
        o.o_orderstatus.alias("order_status"),
        F.date_format(o.o_orderdate, "yyyy-MM-dd HH:mm:ss").alias("order_purchase_timestamp"),
    )


# Total order of the line columns used to renumber lines within an order.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")


def bronze_order_items(spark: SparkSession, base: str, renumber: bool = False) -> DataFrame:
    """Order items from lineitem; price and freight (price x tax) in decimal.

    The test data's (l_orderkey, l_linenumber) is not unique.  ``renumber``
    gives each line of an order its position 1..n by ``LINE_ORDER`` instead,
    which makes (order_id, order_item_id) a key for the upsert.
    """
    li = read_table(spark, base, "lineitem").dropna(subset=["l_orderkey", "l_linenumber", "l_partkey"])
    price = F.col("l_extendedprice").cast(MONEY)
    if renumber:
        # Skew-safe: an order with a huge number of lines is split over tasks.
        li = number_within_groups(li, ["l_orderkey"], list(LINE_ORDER), col="_line")
        item_id = F.col("_line").cast("int")
    else:
        item_id = li.l_linenumber
    return li.select(
        li.l_orderkey.cast("string").alias("order_id"),
        item_id.alias("order_item_id"),
        li.l_partkey.cast("string").alias("product_id"),
        li.l_suppkey.cast("string").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY_PRODUCT).alias("freight_value"),
        li.l_discount.cast("decimal(4,2)").alias("discount"),
    )


def bronze_customers(spark: SparkSession, base: str, identity: str = "account") -> DataFrame:
    """Customers with city from the nation table.

    ``identity`` picks the person key: ``account`` (one person per customer
    key) or ``household`` (nation and market segment: several customer ids
    per person, which exercises the dedup and the customer-link modes).
    """
    c = read_table(spark, base, "customer")
    n = read_table(spark, base, "nation").select("n_nationkey", "n_name")
    if identity == "account":
        unique_id = c.c_custkey.cast("string")
    elif identity == "household":
        unique_id = F.concat_ws("-", c.c_nationkey.cast("string"), c.c_mktsegment)
    else:
        raise ValueError(f"unknown identity {identity!r}")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(c.c_custkey.cast("string").alias("customer_id"),
                    unique_id.alias("customer_unique_id"),
                    n.n_name.alias("customer_city"),
                    c.c_mktsegment.alias("customer_segment")))


def bronze_products(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "part")
    return p.select(
        p.p_partkey.cast("string").alias("product_id"),
        p.p_type.alias("product_category_name"),
        p.p_name.alias("product_name"),
        p.p_brand.alias("product_brand"),
        p.p_size.alias("product_size"),
    )


def category_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CATEGORY_TRANSLATION_ROWS,
        "product_category_name string, product_category_name_english string")


def bronze_tables(spark: SparkSession, base: str, identity: str = "account",
                  renumber: bool = False) -> dict[str, DataFrame]:
    """All five raw roles over the driver's tables."""
    return {
        "orders": bronze_orders(spark, base),
        "order_items": bronze_order_items(spark, base, renumber),
        "customers": bronze_customers(spark, base, identity),
        "products": bronze_products(spark, base),
        "category_translation": category_translation(spark),
    }
