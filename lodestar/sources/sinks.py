"""Sinks: full refresh with schema evolution, views and table listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources import store


def evolve_schema(df: DataFrame, old_schema) -> DataFrame:
    """Old columns missing from ``df`` are added as typed nulls (old ∪ new).

    A column that changes its type is refused.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changed = [f.name for f in old_schema.fields if kinds.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise TypeError(f"columns {changed} change their type")
    missing = [f for f in old_schema.fields if f.name not in kinds]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def overwrite_evolving(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace the rows of the stored table ``name`` by ``df``; its schema becomes old ∪ new columns.

    The replacement is a new version, switched on only after it is written.
    """
    spark = df.sparkSession
    if store.exists(spark, name):
        df = evolve_schema(df, spark.table(name).schema)
    store.save_version(df, name, path)
    return spark.table(name)


def publish_views(spark: SparkSession, frames: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """``CREATE OR REPLACE TEMPORARY VIEW`` for each frame; returns the names."""
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def list_tables(spark: SparkSession, database: str | None = None, like: str | None = None) -> DataFrame:
    """Tables and temporary views as a DataFrame (``SHOW TABLES``)."""
    where = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{where}" + (f" LIKE '{like}'" if like else ""))


def save_bucketed(df: DataFrame, name: str, bucket_cols: list[str], num_buckets: int,
                  sort_cols: list[str] | None = None) -> str:
    """Publish ``df`` as a catalog table bucketed (hash-partitioned) by ``bucket_cols``.

    Aggregates and joins keyed by the bucket columns (e.g. distinct orders per
    month or per customer with ``order_id`` buckets) read it without a
    shuffle of the fact.  Returns the physical table name.
    """
    return store.save_version(df, name, bucket_by=bucket_cols, buckets=num_buckets, sort_by=sort_cols or ())
