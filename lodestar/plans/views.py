"""The five reporting views as DataFrame functions.

Money is summed exactly (integer minor units, see ``exact_sum_parts``) and
rounded half-up to 2 places at the end (``r2``); ratios divide doubles and
are rounded the same way.  Every tie in an ordering that feeds a ntile or a
limit gets the row key as tiebreak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lodestar.functions.money import (exact_sum_parts, exact_sum_value, merge_sum_parts, r2,
                                      r2_ratio)
from lodestar.operators.ranking import rank_globally


class _Sum:
    """An exact money sum: aggregate expressions plus the value after aggregation."""

    def __init__(self, df: DataFrame, column: str, name: str):
        dt = df.schema[column].dataType
        self.name = name
        self.scale = dt.scale if isinstance(dt, DecimalType) and dt.precision <= 18 else None
        self.column = column

    def parts(self) -> list[Column]:
        if self.scale is None:
            return [F.sum(self.column).alias(self.name)]
        return exact_sum_parts(self.column, self.name, self.scale)

    def merge(self) -> list[Column]:
        if self.scale is None:
            return [F.sum(self.name).alias(self.name)]
        return merge_sum_parts(self.name)

    def value(self) -> Column:
        if self.scale is None:
            return F.col(self.name)
        return exact_sum_value(self.name, self.scale)


def _sort_small(df: DataFrame, *order: Column) -> DataFrame:
    """Order a result whose size is bounded by the calendar (months, years).

    One task sorts it; no range-partitioning sample job for a few rows.
    """
    return df.coalesce(1).sortWithinPartitions(*order)


def executive_kpis(fact: DataFrame, strategy: str = "preagg") -> DataFrame:
    """Lifetime orders, customers, revenue and average order value; one row.

    ``preagg`` (default): lines are first combined per (order, customer), then
    the distinct counts run on that.
    ``expand``: one aggregate with two distinct counts; Spark expands each line
    into one row per distinct column before the first aggregate.
    ``split``: for a stored fact bucketed by ``order_id``.  Order count and
    revenue are one aggregate with a single distinct column (no Expand, no
    shuffle of lines: each order lives in one bucket); the customer count is
    a scalar subquery, partial-distinct map-side then one shuffle of about
    one row per customer and task.  The fact is read twice, so a lazily
    built fact would be computed twice: use it on stored tables only.
    """
    rev = _Sum(fact, "sales_amount", "_rev")
    if strategy == "preagg":
        per_order = fact.groupBy("order_id", "customer_sk").agg(*rev.parts())
        agg = per_order.agg(F.count_distinct("order_id").alias("total_lifetime_orders"),
                            F.count_distinct("customer_sk").alias("total_unique_customers"),
                            *rev.merge())
    elif strategy == "split":
        customers = fact.agg(F.count_distinct("customer_sk")).scalar()
        agg = (fact.agg(F.count_distinct("order_id").alias("total_lifetime_orders"), *rev.parts())
               .withColumn("total_unique_customers", customers))
    elif strategy == "expand":
        agg = fact.agg(F.count_distinct("order_id").alias("total_lifetime_orders"),
                       F.count_distinct("customer_sk").alias("total_unique_customers"),
                       *rev.parts())
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return agg.select(
        "total_lifetime_orders",
        "total_unique_customers",
        r2(rev.value()).alias("total_lifetime_revenue"),
        r2_ratio(rev.value(), F.col("total_lifetime_orders")).alias("average_order_value"),
    )


def _dated(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Inner join with the calendar.  The calendar has one row per day; the
    planner broadcasts it by its size estimate (a stored calendar is a few
    KB), otherwise it falls back to a shuffle join."""
    d = dates.select("date_sk", "calendar_year", "calendar_month")
    return fact.join(d, fact["order_date_sk"] == d["date_sk"], "inner")


def monthly_sales(fact: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    sales, freight = _Sum(fact, "sales_amount", "_s"), _Sum(fact, "freight_value", "_f")
    out = (_dated(fact, dates)
           .groupBy(F.col("calendar_year").alias("sales_year"),
                    F.col("calendar_month").alias("sales_month"))
           .agg(F.count_distinct("order_id").alias("total_orders"),
                F.count("order_item_id").alias("total_items_sold"),
                *sales.parts(), *freight.parts())
           .select("sales_year", "sales_month", "total_orders", "total_items_sold",
                   r2(sales.value()).alias("total_revenue"),
                   r2(freight.value()).alias("total_freight_cost")))
    return _sort_small(out, F.desc("sales_year"), F.desc("sales_month")) if ordered else out


def yoy_growth(fact: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue per year against the previous *row* (a missing year compares
    with the last year present).  The window sees one row per calendar year."""
    sales = _Sum(fact, "sales_amount", "_s")
    yearly = (_dated(fact, dates).groupBy("calendar_year").agg(*sales.parts())
              .select("calendar_year", sales.value().alias("_t")))
    prev = F.lag("_t").over(Window.orderBy("calendar_year"))
    out = (yearly.withColumn("_p", prev)
           .select("calendar_year",
                   r2(F.col("_t")).alias("current_revenue"),
                   r2(F.col("_p")).alias("previous_year_revenue"),
                   r2_ratio(F.col("_t") - F.col("_p"), F.col("_p"), 100).alias("yoy_growth_percentage")))
    return _sort_small(out, F.desc("calendar_year")) if ordered else out


def customer_metrics(fact: DataFrame) -> DataFrame:
    """Per customer: distinct orders and unrounded lifetime value (> 0 only)."""
    sales = _Sum(fact, "sales_amount", "_s")
    return (fact.groupBy("customer_sk")
            .agg(F.count_distinct("order_id").alias("total_orders"), *sales.parts())
            .select("customer_sk", "total_orders", sales.value().alias("_ltv"))
            .where(F.col("_ltv") > 0))


def customer_ltv(fact: DataFrame, ordered: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Customers ranked by lifetime value: decile (ntile 10, ties broken by
    customer_sk) and dense rank (ties share a rank).

    One plan for every size: customers are dealt by ranges of their value and
    ranked inside them (``rank_globally``); no task ranks them all.
    """
    ranked = rank_globally(customer_metrics(fact), "_ltv", "customer_sk", 10, "ltv_decile", "ltv_rank",
                           num_partitions=num_partitions)
    out = ranked.select("customer_sk", "total_orders", r2(F.col("_ltv")).alias("lifetime_value"),
                        "ltv_decile", "ltv_rank")
    return out.orderBy("ltv_rank", "customer_sk") if ordered else out


def category_freight(fact: DataFrame, products: DataFrame, ordered: bool = True,
                     min_revenue: int = 1000) -> DataFrame:
    """Freight cost relative to revenue per known category with revenue > 1000.

    Lines are aggregated per product before the product join (map-side
    combine: one row per product and task in the shuffle, and the join sees
    one row per product instead of one per line); the per-product partial
    counts and sums add up to exactly the per-category totals, also when a
    product key occurs twice in the dimension.
    """
    sales, freight = _Sum(fact, "sales_amount", "_s"), _Sum(fact, "freight_value", "_f")
    per_product = fact.groupBy("product_sk").agg(
        F.count("order_item_id").alias("_n"), *sales.parts(), *freight.parts())
    cats = (products.select("product_sk", "product_category_name")
            .where(F.col("product_category_name") != "unknown"))
    out = (per_product.join(cats, "product_sk")
           .groupBy("product_category_name")
           .agg(F.sum("_n").alias("items_sold"), *sales.merge(), *freight.merge())
           .withColumns({"_sv": sales.value(), "_fv": freight.value()})
           .where(F.col("_sv") > min_revenue)
           .select("product_category_name", "items_sold",
                   r2(F.col("_sv")).alias("total_revenue"),
                   r2(F.col("_fv")).alias("total_freight_cost"),
                   r2_ratio(F.col("_fv"), F.col("_sv"), 100).alias("freight_to_revenue_ratio")))
    return out.orderBy(F.desc("freight_to_revenue_ratio"), "product_category_name") if ordered else out
