"""Silver layer: null-key removal, deterministic dedup, normalisation,
timestamp parsing and category translation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import normalize_text, parse_timestamp
from lodestar.operators.stamps import stamp_value

ORDER_TIMESTAMP_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
UNKNOWN_CATEGORY = "unknown"


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop a row when any listed key is null."""
    return df.dropna(how="any", subset=list(keys))


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the smallest by ``order``, then by the other columns.

    Expressed as ``min(struct(order..., rest...))`` per key, so Spark combines
    map-side: a key holding a third of all rows costs one row per task in
    the shuffle instead of a sort of that whole group.  The choice is total
    and deterministic (nulls sort first within the struct).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = F.min(F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])).alias("_keep")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_keep.`{c}`").alias(c)
                        for c in df.columns])


def clean_customers(df: DataFrame, as_of=None, dedup_key: str = "customer_unique_id",
                    order: Sequence[str] = ("customer_id",)) -> DataFrame:
    out = drop_null_keys(df, ["customer_id", "customer_unique_id"])
    out = keep_first(out, dedup_key, list(order))
    return out.withColumns({
        "customer_city": normalize_text("customer_city"),
        "_updated_timestamp": stamp_value(as_of),
    })


def clean_orders(df: DataFrame, as_of=None,
                 timestamp_cols: Sequence[str] = ORDER_TIMESTAMP_COLUMNS) -> DataFrame:
    out = drop_null_keys(df, ["order_id", "customer_id"])
    present = [c for c in timestamp_cols if c in out.columns]
    cols = {c: parse_timestamp(c) for c in present}
    cols["_updated_timestamp"] = stamp_value(as_of)
    return out.withColumns(cols)


def unparsed_timestamps(df: DataFrame,
                        timestamp_cols: Sequence[str] = ORDER_TIMESTAMP_COLUMNS) -> DataFrame:
    """One row: per timestamp column, rows whose non-null text did not parse."""
    present = [c for c in timestamp_cols if c in df.columns]
    return df.agg(*[
        F.count(F.when(F.col(c).isNotNull() & parse_timestamp(c).isNull(), 1)).alias(f"{c}_nulled")
        for c in present
    ])


def category_lookup(translation: DataFrame) -> DataFrame:
    """One English name per source category (duplicates would fan out products).

    Only the two lookup columns are kept, so no stamp column is joined twice.
    """
    t = translation.select("product_category_name", "product_category_name_english")
    return (t.where(F.col("product_category_name").isNotNull())
            .groupBy("product_category_name")
            .agg(F.min("product_category_name_english").alias("product_category_name_english")))


def localize_products(products: DataFrame, translation: DataFrame, as_of=None) -> DataFrame:
    """Translate categories; unmatched and null categories become 'unknown'."""
    out = drop_null_keys(products, ["product_id"])
    out = out.join(category_lookup(translation), on="product_category_name", how="left")
    out = out.withColumn("product_category_name",
                         F.coalesce(F.col("product_category_name_english"), F.lit(UNKNOWN_CATEGORY)))
    return out.drop("product_category_name_english").withColumn("_updated_timestamp", stamp_value(as_of))


def clean_items(df: DataFrame, as_of=None) -> DataFrame:
    out = drop_null_keys(df, ["order_id", "order_item_id", "product_id"])
    return out.withColumn("_updated_timestamp", stamp_value(as_of))
