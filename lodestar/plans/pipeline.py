"""The whole run in dependency order, with the quality gate before publish.

bronze -> silver (4 tables) -> dimensions and fact, all saved under a new
release number -> checks on these tables -> one switch makes the release
current, or an error leaves the one before in place.  The ledger is added to
an audit table either way.

The fact is partitioned by the month of the order.  A run writes the months
that its lines touch (months that a corrected line leaves included); the new
release takes over the files of all others.  Staged copies go when the run
ends, releases before the newest ``keep`` after a publish.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import cleaning, dims
from lodestar.operators import fact as fact_ops
from lodestar.operators.layout import cluster_by
from lodestar.operators.quality import QualityGateError, standard_suite
from lodestar.operators.upsert import _in, as_text, assert_unique_keys, merge_rows, touched_partitions
from lodestar.plans import rollups
from lodestar.sources import store
from lodestar.sources.store import Releases

# Clustering columns per table (the layout step after each write).
LAYOUT = {
    "silver_customers": ["customer_unique_id"],
    "silver_orders": ["order_id", "customer_id"],
    "silver_products": ["product_id"],
    "silver_order_items": ["order_id", "product_id"],
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "dim_date": ["date_sk"],
    "fact_sales": ["order_date_sk", "customer_sk", "product_sk"],
}
#: The fact's partition column: year and month of the order date key.
MONTH = "order_month"


@dataclass
class RunResult:
    ledger: DataFrame
    release: int
    published: bool
    months: list  # months of the fact that this run wrote


def run_pipeline(spark: SparkSession, bronze: dict[str, DataFrame], name: str, path: str | None = None,
                 customer_link: str = "deduped", calendar: tuple[str, str] | None = None,
                 as_of=None, cluster: bool = True, fact_keys=fact_ops.FACT_KEYS,
                 enforce: bool = True, keep: int = 2, reports: bool = False) -> RunResult:
    """Run everything as the next release of ``name`` (tables under ``path``).

    With ``reports``, the release also holds the monthly states of the views
    (``rollups.Reports``), refreshed for the months that the run writes.

    ``published`` tells whether the release is current now: with failed
    critical checks it is not, whether or not ``enforce`` raises.
    """
    with store.Staging(spark, name) as staging:
        return _run(spark, bronze, Releases(spark, name, path), staging, customer_link, calendar, as_of, cluster, fact_keys, enforce, keep, reports)


def _run(spark, bronze, releases, staging, customer_link, calendar, as_of, cluster, fact_keys, enforce, keep, reports) -> RunResult:
    name, path = releases.name, releases.path
    before, number = releases.current(), releases.begin()

    def save(table: str, df: DataFrame) -> DataFrame:
        if not cluster:
            return releases.save(df, table, number)
        saved = releases.save(cluster_by(staging.put(df, table), LAYOUT[table]), table, number)
        staging.drop(table)
        return saved

    def save_fact(updates: DataFrame) -> tuple[DataFrame, list]:
        old = None if before is None else releases.read("fact_sales", before)
        if old is None:
            months, changed = [r[0] for r in updates.select(MONTH).distinct().collect()], updates  # a row a month
        else:
            months = touched_partitions(old, updates, fact_keys, MONTH)
            changed = merge_rows(old.where(_in(MONTH, months)), updates, fact_keys)
        if cluster:
            if old is not None:
                changed = staging.put(changed, "fact_sales")
                staging.drop("lines")
            changed = cluster_by(changed, LAYOUT["fact_sales"], within=MONTH)
        saved = releases.save_partitioned(changed, "fact_sales", number, MONTH, before, as_text(months), clustered=cluster)
        for copy in ("lines", "fact_sales"):  # nothing reads them any more
            staging.drop(copy)
        return saved, months

    sc = save("silver_customers", cleaning.clean_customers(bronze["customers"], as_of))
    so = save("silver_orders", cleaning.clean_orders(bronze["orders"], as_of))
    sp = save("silver_products", cleaning.localize_products(bronze["products"], bronze["category_translation"], as_of))
    si = save("silver_order_items", cleaning.clean_items(bronze["order_items"], as_of))

    dim_customer = save("dim_customer", dims.dim_customer(sc))
    dim_product = save("dim_product", dims.dim_product(sp))
    dim_date = save("dim_date", dims.dim_date(spark, *calendar) if calendar
                    else dims.dim_date_covering(so, "order_purchase_timestamp"))
    lines = fact_ops.fact_lines(so, sc, si, customer_link, bronze_customers=bronze["customers"])
    stamp = F.lit(as_of or spark.range(1).select(F.current_timestamp()).first()[0])  # one time for every reading of the lines
    updates = fact_ops.keyed_fact(staging.put(lines.select(*fact_ops.LINE_PARTS), "lines"), stamp)
    updates = updates.withColumn(MONTH, F.floor(F.col("order_date_sk") / 100).cast("int"))
    assert_unique_keys(updates, fact_keys)
    fact, months = save_fact(updates)

    suite = standard_suite(fact, dim_customer, dim_product, dim_date, as_of)
    with store.settled(spark):
        rows = suite.ledger().collect()  # a row a check
    ledger = spark.createDataFrame(rows, suite.ledger().schema)
    audit = ledger.write.mode("append").format("parquet")
    (audit.option("path", f"{path.rstrip('/')}/{name}__audit_log") if path else audit).saveAsTable(f"{name}__audit_log")
    failed = [r for r in rows if r["status"] == "FAIL" and r["severity"] == "CRITICAL"]
    if failed and enforce:
        raise QualityGateError(f"{len(failed)} critical check(s) failed; gold not published")
    if not failed:
        if reports:
            rollups.refresh(releases, number, before, months, MONTH)
        releases.publish(number)
        releases.retire(keep)
    return RunResult(ledger, number, not failed, months)
