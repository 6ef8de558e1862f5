"""Named reads: defaults, range checks, decile after ranking."""

import pytest

from lodestar.plans import named
from lodestar.plans.star import publish_star, star_from_tables
from tests.conftest import SF001


@pytest.fixture(scope="module")
def star(spark):
    return star_from_tables(spark, SF001)


def test_defaults_and_limits(star):
    assert named.run_named(star, "monthly_trends").count() == 12
    assert named.run_named(star, "top_customers").count() == 20
    assert named.run_named(star, "sales_summary").count() == 1
    with pytest.raises(ValueError):
        named.run_named(star, "monthly_trends", months=61)
    with pytest.raises(ValueError):
        named.run_named(star, "top_customers", limit=0)
    with pytest.raises(KeyError):
        named.run_named(star, "nope")


def test_decile_filter_keeps_global_ranks(star):
    d2 = named.top_customers(star, limit=500, decile=2).collect()
    assert d2 and all(r["ltv_decile"] == 2 for r in d2)
    assert min(r["ltv_rank"] for r in d2) > 1


def test_monthly_newest_first(star):
    rows = named.monthly_trends(star, 3).collect()
    keys = [(r["sales_year"], r["sales_month"]) for r in rows]
    assert keys == sorted(keys, reverse=True)


def test_bounds_are_those_of_the_served_presets_only(star):
    with pytest.raises(ValueError):
        named.run_named(star, "top_customers", limit=501)
    assert named.top_customers(star, limit=None).count() > 0
    assert named.monthly_trends(star, 600).count() > 60


def test_view_scan_limit_zero_or_none_means_all(spark, star):
    from lodestar.plans import views
    m = views.monthly_sales(star.fact, star.dim_date)
    total = m.count()
    publish_star(spark, star, "named_")
    assert named.view_scan(spark, "named_monthly_sales").count() == total
    assert named.view_scan(spark, "named_monthly_sales", 0).count() == total
    assert named.view_scan(spark, "named_monthly_sales", 5).count() == 5
