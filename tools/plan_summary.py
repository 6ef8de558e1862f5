"""Summarise the physical plans of the reporting views over a stored gold star.

usage: python tools/plan_summary.py [sf_dir]
Prints, per view: exchanges (by partitioning), join strategies, fact columns read.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.operators.stamps import without_stamps  # noqa: E402
from lodestar.plans import views  # noqa: E402
from lodestar.plans.star import read_gold, star_from_tables  # noqa: E402
from lodestar.session import local_session  # noqa: E402
from lodestar.sources.sinks import save_bucketed  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    parts = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"
                       r"(\(([^)]*)\))?", text)
    ex = [p[0] + (f"({p[2].split(',')[0]}...)" if p[2] else "") for p in parts]
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \w+", text)))
    return f"exchanges={len(ex)} {ex} joins={joins}"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    base = tempfile.mkdtemp(prefix="lodestar-plans-")
    s = star_from_tables(spark, sf)
    save_bucketed(without_stamps(s.fact), "plan_fact_sales", ["order_id"], 8)
    for name in ("dim_customer", "dim_product", "dim_date"):
        without_stamps(getattr(s, name)).write.parquet(f"{base}/{name}")
    g = read_gold(spark, base, fact=spark.table("plan_fact_sales"))
    for name, df in [
        ("executive_kpis", views.executive_kpis(g.fact)),
        ("monthly_sales", views.monthly_sales(g.fact, g.dim_date)),
        ("yoy_growth", views.yoy_growth(g.fact, g.dim_date)),
        ("customer_ltv", views.customer_ltv(g.fact)),
        ("category_freight", views.category_freight(g.fact, g.dim_product)),
    ]:
        print(f"{name:22s} {summary(plan(df))}")
    spark.stop()


if __name__ == "__main__":
    main()
