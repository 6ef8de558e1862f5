"""Named, parameterised reads over the views (typed arguments, no SQL text).

Limits are positive; the upper bounds of the served presets stand in
``REGISTRY`` alone.  Orderings that feed a limit carry a row-key
tiebreak so the same call always returns the same rows.  ``orderBy + limit``
plans as a per-task top-k (``TakeOrderedAndProject``), not a full sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.plans import views
from lodestar.plans.star import Star


def check_range(name: str, value: int, lo: int, hi: int | None = None) -> int:
    if not isinstance(value, int) or isinstance(value, bool) or value < lo or hi is not None and value > hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {'...' if hi is None else hi}], got {value!r}")
    return value


def view_scan(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """``SELECT * FROM <view> [LIMIT n]`` by name; a limit of 0 or None means all rows."""
    df = spark.table(name)
    return df.limit(limit) if limit else df


def sales_summary(star: Star) -> DataFrame:
    return views.executive_kpis(star.fact).limit(1)


def monthly_trends(star: Star, months: int = 12) -> DataFrame:
    check_range("months", months, 1)
    return (views.monthly_sales(star.fact, star.dim_date, ordered=False)
            .orderBy(F.desc("sales_year"), F.desc("sales_month")).limit(months))


def yoy_growth(star: Star) -> DataFrame:
    return views.yoy_growth(star.fact, star.dim_date, ordered=False).orderBy(F.desc("calendar_year"))


def top_customers(star: Star, limit: int | None = 20, decile: int | None = None) -> DataFrame:
    """Customers by rank; the decile filter applies after ranking, so ranks
    stay global.  Without a limit all are returned."""
    if limit is not None:
        check_range("limit", limit, 1)
    ranked = views.customer_ltv(star.fact, ordered=False)
    if decile is not None:
        check_range("decile", decile, 1, 10)
        ranked = ranked.where(F.col("ltv_decile") == F.lit(decile))
    ranked = ranked.orderBy("ltv_rank", "customer_sk")
    return ranked if limit is None else ranked.limit(limit)


def category_analysis(star: Star, limit: int | None = None) -> DataFrame:
    out = views.category_freight(star.fact, star.dim_product, ordered=False) \
        .orderBy(F.desc("freight_to_revenue_ratio"), "product_category_name")
    if limit is not None:
        check_range("limit", limit, 1)
        out = out.limit(limit)
    return out


@dataclass(frozen=True)
class NamedQuery:
    """A preset of a served read: defaults, and the largest values it serves."""

    fn: Callable[..., DataFrame]
    defaults: dict
    most: dict = field(default_factory=dict)


REGISTRY: dict[str, NamedQuery] = {
    "sales_summary": NamedQuery(sales_summary, {}),
    "monthly_trends": NamedQuery(monthly_trends, {"months": 12}, {"months": 60}),
    "yoy_growth": NamedQuery(yoy_growth, {}),
    "top_customers": NamedQuery(top_customers, {"limit": 20}, {"limit": 500}),
    "category_analysis": NamedQuery(category_analysis, {}, {"limit": 100}),
}


def run_named(star: Star, name: str, **kwargs) -> DataFrame:
    """Look up a named query and call it with its defaults overridden by kwargs."""
    try:
        q = REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown query {name!r}; known: {sorted(REGISTRY)}") from None
    args = {**q.defaults, **kwargs}
    for arg, most in q.most.items():
        if args.get(arg) is not None:
            check_range(arg, args[arg], 1, most)
    return q.fn(star, **args)
