"""Physical-plan properties."""

import contextlib
import io

import pytest

from lodestar.operators.stamps import without_stamps
from lodestar.plans import named, views
from lodestar.plans.star import read_gold, star_from_tables
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("gold"))
    s = star_from_tables(spark, SF001)
    for name, df in s.tables().items():
        without_stamps(df).write.parquet(f"{base}/{name}")
    return read_gold(spark, base)


def _fact_read_schema(text: str) -> str:
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Location" in line and "fact_sales" in line:
            return next(x for x in lines[i:i + 6] if x.startswith("ReadSchema"))
    raise AssertionError("no fact scan")


def test_kpi_prunes_columns(gold):
    schema = _fact_read_schema(plan(views.executive_kpis(gold.fact)))
    assert "freight_value" not in schema and "product_sk" not in schema
    assert "order_id" in schema and "sales_amount" in schema


def test_topk_is_take_ordered(gold):
    text = plan(named.top_customers(gold, 20))
    assert "TakeOrderedAndProject" in text
    text = plan(named.monthly_trends(gold, 12))
    assert "TakeOrderedAndProject" in text


def test_ltv_has_no_single_partition_on_customer_rows(gold):
    text = plan(views.customer_ltv(gold.fact, ordered=False))
    # One row a range, or the sample's one row of bounds, is all that meets in one partition.
    for line in (x for x in text.splitlines() if x.startswith("Arguments") and "SinglePartition" in x):
        assert "_ltv" not in line
    # Ranked rows are shuffled once, by their range.
    assert "ShufflePartitionIdPassThrough" in text or "_range" in text
    assert "hashpartitioning(_range" not in text


def test_building_top_customers_starts_no_job(spark, gold):
    group = "building-top-customers"
    spark.sparkContext.setJobGroup(group, group)
    try:
        named.top_customers(gold, 20)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_calendar_join_is_broadcast_and_filters_pushed(gold):
    text = plan(views.monthly_sales(gold.fact, gold.dim_date))
    assert "BroadcastHashJoin" in text
    assert "PushedFilters: [IsNotNull(order_date_sk)]" in text


def test_freight_aggregates_before_join(gold):
    text = plan(views.category_freight(gold.fact, gold.dim_product, ordered=False))
    # A partial aggregate keyed by product_sk exists, i.e. lines are combined
    # per product before the product join.
    assert "Keys [1]: [product_sk" in text
    assert "Not(EqualTo(product_category_name,unknown))" in text


def test_kpi_split_shuffles_no_order_keys(spark, gold):
    from lodestar.sources.sinks import save_bucketed
    save_bucketed(gold.fact, "lodestar_test_kpi_fact", ["order_id"], 4)
    fact = spark.table("lodestar_test_kpi_fact")
    text = plan(views.executive_kpis(fact, strategy="split"))
    exchanges = [x for x in text.splitlines() if "hashpartitioning(" in x]
    assert exchanges and all("order_id" not in x for x in exchanges)
    assert any("customer_sk" in x for x in exchanges)
    assert "Expand" not in text
    assert (views.executive_kpis(fact, strategy="split").collect()
            == views.executive_kpis(gold.fact).collect())
