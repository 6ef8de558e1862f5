"""Reporting views on hand-made facts."""

from decimal import Decimal

import pytest

from lodestar.operators import dims
from lodestar.plans import views

FACT = ("order_id string, order_item_id int, customer_sk string, product_sk string, "
        "order_date_sk int, sales_amount decimal(18,2), freight_value decimal(18,4)")


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_calendar_bounds_filter_monthly_not_kpi(spark):
    # Dates outside 2016..2020 and null drop from monthly, stay in KPIs.
    rows = [("o1", 1, "c", "p", 20151231, Decimal("1"), Decimal("0")),
            ("o2", 1, "c", "p", 20160101, Decimal("1"), Decimal("0")),
            ("o3", 1, "c", "p", 20201231, Decimal("1"), Decimal("0")),
            ("o4", 1, "c", "p", 20210101, Decimal("1"), Decimal("0")),
            ("o5", 1, "c", "p", None, Decimal("1"), Decimal("0"))]
    f = fact(spark, rows)
    m = views.monthly_sales(f, dims.dim_date(spark)).collect()
    assert sum(r["total_orders"] for r in m) == 2
    assert views.executive_kpis(f).collect()[0]["total_lifetime_orders"] == 5


@pytest.mark.parametrize("strategy", ["split", "expand", "preagg"])
def test_kpi_empty_and_null_orders(spark, strategy):
    # Empty fact -> one row of null money; all order ids null -> AOV null, no error.
    empty = views.executive_kpis(fact(spark, []), strategy).collect()
    assert len(empty) == 1 and empty[0]["average_order_value"] is None
    assert empty[0]["total_lifetime_orders"] == 0
    nulls = fact(spark, [(None, 1, "c", "p", 20180101, Decimal("5"), Decimal("0"))])
    r = views.executive_kpis(nulls, strategy).collect()[0]
    assert r["total_lifetime_revenue"] == 5.0 and r["average_order_value"] is None


def test_kpi_strategies_agree(spark):
    rows = [(f"o{i % 7}", i, f"c{i % 3}", "p", 20180101, Decimal(i) / 4, Decimal("0")) for i in range(50)]
    f = fact(spark, rows)
    split = views.executive_kpis(f, "split").collect()
    assert split == views.executive_kpis(f, "expand").collect() == views.executive_kpis(f, "preagg").collect()


def test_yoy_by_row_with_gap(spark):
    # 2016: 100, 2018: 150, 2019: 0, 2020: 50.
    rows = [("a", 1, "c", "p", 20160505, Decimal("100"), Decimal("0")),
            ("b", 1, "c", "p", 20180505, Decimal("150"), Decimal("0")),
            ("c", 1, "c", "p", 20190505, Decimal("0"), Decimal("0")),
            ("d", 1, "c", "p", 20200505, Decimal("50"), Decimal("0"))]
    out = {r["calendar_year"]: r for r in views.yoy_growth(fact(spark, rows), dims.dim_date(spark)).collect()}
    assert out[2016]["previous_year_revenue"] is None and out[2016]["yoy_growth_percentage"] is None
    assert out[2018]["previous_year_revenue"] == 100.0 and out[2018]["yoy_growth_percentage"] == 50.0
    assert out[2019]["yoy_growth_percentage"] == -100.0
    assert out[2020]["previous_year_revenue"] == 0.0 and out[2020]["yoy_growth_percentage"] is None


@pytest.mark.parametrize("strategy", ["scaled", "window"])
def test_ltv_ties_filter_and_tiles(spark, strategy):
    # 11 customers: two tied, one zero, one negative, one null.
    vals = {"c1": "90", "c2": "80", "c3": "80", "c4": "70", "c5": "60", "c6": "50", "c7": "40",
            "c8": "30", "c9": "0", "c10": "-5", "c11": None}
    rows = [(f"o{k}", 1, k, "p", 20180101, None if v is None else Decimal(v), Decimal("0"))
            for k, v in vals.items()]
    out = {r["customer_sk"]: r for r in views.customer_ltv(fact(spark, rows), strategy,
                                                          num_partitions=3).collect()}
    assert set(out) == {f"c{i}" for i in range(1, 9)}
    assert out["c2"]["ltv_rank"] == out["c3"]["ltv_rank"] == 2
    assert out["c4"]["ltv_rank"] == 3
    assert sorted(r["ltv_decile"] for r in out.values()) == list(range(1, 9))
    assert out["c2"]["ltv_decile"] == 2 and out["c3"]["ltv_decile"] == 3


def test_category_having_and_unknown(spark):
    # Sums exactly 1000.00 and 1000.01; 'unknown' and null categories excluded.
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", "unknown"), ("p4", None)],
                                     "product_sk string, product_category_name string")
    rows = [("o1", 1, "c", "p1", 20180101, Decimal("1000.00"), Decimal("1")),
            ("o2", 1, "c", "p2", 20180101, Decimal("1000.01"), Decimal("10")),
            ("o3", 1, "c", "p3", 20180101, Decimal("5000"), Decimal("1")),
            ("o4", 1, "c", "p4", 20180101, Decimal("5000"), Decimal("1"))]
    out = views.category_freight(fact(spark, rows), products).collect()
    assert [r["product_category_name"] for r in out] == ["b"]
    assert out[0]["freight_to_revenue_ratio"] == 1.0 and out[0]["items_sold"] == 1


def test_category_preaggregation_with_duplicate_dimension_rows(spark):
    # A product key twice in the dimension doubles its lines, as the plain join does.
    products = spark.createDataFrame([("p1", "a"), ("p1", "a")], "product_sk string, product_category_name string")
    rows = [("o1", 1, "c", "p1", 20180101, Decimal("800"), Decimal("8"))]
    out = views.category_freight(fact(spark, rows), products).collect()
    assert out[0]["items_sold"] == 2 and out[0]["total_revenue"] == 1600.0
