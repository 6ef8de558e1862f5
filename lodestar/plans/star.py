"""Assemble the star (silver -> dims + fact) over the driver's tables, lazily."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators import cleaning, dims, fact as fact_ops
from lodestar.plans import views
from lodestar.sources import tables
from lodestar.sources.sinks import publish_views
from lodestar.sources.store import Releases


@dataclass
class Star:
    bronze: dict[str, DataFrame]
    silver_customers: DataFrame
    silver_orders: DataFrame
    silver_products: DataFrame
    silver_items: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_sales": self.fact, "dim_customer": self.dim_customer,
                "dim_product": self.dim_product, "dim_date": self.dim_date}


def publish_star(spark: SparkSession, star: Star, prefix: str = "") -> list[str]:
    """Gold tables and the five reporting views as named SQL views of the session."""
    reports = {
        "executive_kpis": views.executive_kpis(star.fact),
        "monthly_sales": views.monthly_sales(star.fact, star.dim_date, ordered=False),
        "yoy_growth": views.yoy_growth(star.fact, star.dim_date, ordered=False),
        "customer_ltv": views.customer_ltv(star.fact, ordered=False),
        "category_freight": views.category_freight(star.fact, star.dim_product, ordered=False),
    }
    return publish_views(spark, {**star.tables(), **reports}, prefix)


def star_from_bronze(spark: SparkSession, bronze: dict[str, DataFrame],
                     customer_link: str = "deduped", calendar: tuple[str, str] | None = None,
                     as_of=None) -> Star:
    """Silver, dimensions and fact from the five raw roles.

    ``calendar`` gives fixed bounds; ``None`` covers the years of the orders.
    """
    sc = cleaning.clean_customers(bronze["customers"], as_of)
    so = cleaning.clean_orders(bronze["orders"], as_of)
    sp = cleaning.localize_products(bronze["products"], bronze["category_translation"], as_of)
    si = cleaning.clean_items(bronze["order_items"], as_of)
    if calendar is None:
        dd = dims.dim_date_covering(so, "order_purchase_timestamp")
    else:
        dd = dims.dim_date(spark, *calendar)
    f = fact_ops.build_fact(so, sc, si, customer_link=customer_link,
                            bronze_customers=bronze["customers"], as_of=as_of)
    return Star(bronze, sc, so, sp, si, dims.dim_customer(sc), dims.dim_product(sp), dd, f)


def star_from_tables(spark: SparkSession, base: str, identity: str = "account",
                     customer_link: str = "deduped", calendar: tuple[str, str] | None = None,
                     as_of=None, renumber: bool = False) -> Star:
    return star_from_bronze(spark, tables.bronze_tables(spark, base, identity, renumber),
                            customer_link, calendar, as_of)


def read_gold(spark: SparkSession, base: str, fact: DataFrame | None = None) -> Star:
    """A star whose gold tables were written as parquet under ``base``
    (``fact`` overrides the fact, e.g. a bucketed catalog table)."""
    def rd(name):
        return spark.read.parquet(f"{base.rstrip('/')}/{name}")
    empty = {}
    f = fact if fact is not None else rd("fact_sales")
    dc, dp, dd = rd("dim_customer"), rd("dim_product"), rd("dim_date")
    return Star(empty, dc, None, dp, None, dc, dp, dd, f)


def read_release(spark: SparkSession, name: str) -> Star:
    """The star of the release that the pipeline published as ``name``."""
    r = Releases(spark, name)
    silver = {t: r.read(f"silver_{t}") for t in ("customers", "orders", "products", "order_items")}
    return Star({}, silver["customers"], silver["orders"], silver["products"], silver["order_items"],
                r.read("dim_customer"), r.read("dim_product"), r.read("dim_date"), r.read("fact_sales").drop("order_month"))
