"""Gold fact: orders x customers x items with surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.keys import date_key, surrogate_key
from lodestar.operators.stamps import stamp_value

FACT_COLUMNS = ("order_id", "order_item_id", "customer_sk", "product_sk", "order_date_sk",
                "sales_amount", "freight_value", "_updated_timestamp")
FACT_KEYS = ("order_id", "order_item_id")
#: The columns of ``fact_lines`` that ``keyed_fact`` needs.
LINE_PARTS = ("order_id", "order_item_id", "customer_unique_id", "product_id", "order_purchase_timestamp", "price", "freight_value")


def customer_id_bridge(bronze_customers: DataFrame) -> DataFrame:
    """Every customer id with its person id (one per customer id, smallest wins).

    Built from the raw customers, so no customer id is lost to the person
    dedup.  Aggregated map-side, skew-safe.
    """
    return (bronze_customers.select("customer_id", "customer_unique_id")
            .dropna(how="any")
            .groupBy("customer_id")
            .agg(F.min("customer_unique_id").alias("customer_unique_id")))


def fact_lines(orders: DataFrame, customers: DataFrame, items: DataFrame,
               customer_link: str = "deduped", bronze_customers: DataFrame | None = None) -> DataFrame:
    """The items with their order's date and person, by natural keys: what a fact is made of, in a fraction of its
    bytes.  A step that stores or shuffles lines does so with these and adds the keys after (``keyed_fact``)."""
    if customer_link == "deduped":
        cust = customers.select("customer_id", "customer_unique_id")
    elif customer_link == "all_ids":
        if bronze_customers is None:
            raise ValueError("customer_link='all_ids' needs bronze_customers")
        cust = customer_id_bridge(bronze_customers)
    else:
        raise ValueError(f"unknown customer_link {customer_link!r}")
    o = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    i = items.drop(*[c for c in ("_updated_timestamp", "_load_timestamp", "customer_id")
                     if c in items.columns])
    return o.join(cust, on="customer_id", how="inner").join(i, on="order_id", how="inner")


def keyed_fact(lines: DataFrame, as_of=None, sales_amount: Column | None = None) -> DataFrame:
    """The fact rows of ``fact_lines``."""
    return lines.select(
        F.col("order_id"),
        F.col("order_item_id"),
        surrogate_key("customer_unique_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        date_key("order_purchase_timestamp").alias("order_date_sk"),
        (F.col("price") if sales_amount is None else sales_amount).alias("sales_amount"),
        F.col("freight_value"),
        stamp_value(as_of).alias("_updated_timestamp"),
    )


def build_fact(orders: DataFrame, customers: DataFrame, items: DataFrame,
               customer_link: str = "deduped", bronze_customers: DataFrame | None = None,
               as_of=None, sales_amount: Column | None = None) -> DataFrame:
    """Denormalise orders, customers and items into fact rows.

    ``customer_link``:
      * ``deduped`` (reference parity): join on the deduplicated customers;
        a person's other customer ids, and their orders, drop out.
      * ``all_ids``: join through :func:`customer_id_bridge` over the raw
        customers, so every order of a known customer id is kept.

    ``sales_amount`` overrides the amount expression (default: the item price).

    Join order: orders meet the narrow customer projection first (a broadcast
    when the planner's size estimate allows it, else a shuffle on
    customer_id), then the much larger items on order_id.  Lines are shuffled
    once.
    """
    return keyed_fact(fact_lines(orders, customers, items, customer_link, bronze_customers), as_of, sales_amount)
