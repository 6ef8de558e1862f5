"""Gold dimensions: surrogate keys and the generated calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.functions.calendar import (DEFAULT_END, DEFAULT_START, calendar_attributes,
                                         calendar_covering, calendar_days)
from lodestar.functions.keys import surrogate_key


def with_surrogate_key(df: DataFrame, natural: str, name: str) -> DataFrame:
    """Add the SHA-256 key of ``natural`` as the first column."""
    out = df.withColumn(name, surrogate_key(natural))
    return out.select(name, *[f"`{c}`" for c in df.columns if c != name])


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    return with_surrogate_key(silver_customers, "customer_unique_id", "customer_sk")


def dim_product(silver_products: DataFrame) -> DataFrame:
    return with_surrogate_key(silver_products, "product_id", "product_sk")


def dim_date(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Calendar dimension over fixed bounds (the reference's default bounds)."""
    return calendar_attributes(calendar_days(spark, start, end))


def dim_date_covering(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar dimension over the whole years that ``ts_col`` spans."""
    return calendar_attributes(calendar_covering(df, ts_col))
