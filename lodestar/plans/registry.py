"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables under ``sf_dir`` in full.  Stamp
columns (current time) are left out of results so that reruns compare.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from lodestar.functions.json import rows_as_json
from lodestar.functions.keys import date_key
from lodestar.functions.money import MONEY
from lodestar.operators import bloom, cleaning, compaction, dims, layout, quality
from lodestar.operators import fact as fact_ops
from lodestar.operators import upsert as upsert_ops
from lodestar.operators.stamps import without_stamps
from lodestar.plans import named, pipeline, rollups, sqlguard, views
from lodestar.plans.star import publish_star, read_release, star_from_bronze, star_from_tables
from lodestar.session import scratch_root
from lodestar.sources import csv as csv_source
from lodestar.sources import schemas, sinks, store, tables

Query = Callable[[SparkSession, str], DataFrame]


def _money_as_double(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def q_fact_build(spark, sf):
    s = star_from_tables(spark, sf)
    return _money_as_double(without_stamps(s.fact), ["sales_amount", "freight_value"])


def q_dim_date(spark, sf):
    return star_from_tables(spark, sf).dim_date


def q_monthly_sales(spark, sf):
    s = star_from_tables(spark, sf)
    return views.monthly_sales(s.fact, s.dim_date)


def q_executive_kpis(spark, sf):
    return views.executive_kpis(star_from_tables(spark, sf).fact)


def q_executive_kpis_split(spark, sf):
    return views.executive_kpis(star_from_tables(spark, sf).fact, strategy="split")


def q_executive_kpis_preagg(spark, sf):
    return views.executive_kpis(star_from_tables(spark, sf).fact, strategy="preagg")


def q_yoy_growth(spark, sf):
    s = star_from_tables(spark, sf)
    return views.yoy_growth(s.fact, s.dim_date)


def q_customer_ltv(spark, sf):
    return views.customer_ltv(star_from_tables(spark, sf).fact)


def q_customer_ltv_scaled(spark, sf):
    return views.customer_ltv(star_from_tables(spark, sf).fact, num_partitions=64)


def q_customer_ltv_window(spark, sf):
    return views.customer_ltv(star_from_tables(spark, sf).fact, num_partitions=2)


def q_category_freight(spark, sf):
    s = star_from_tables(spark, sf)
    return views.category_freight(s.fact, s.dim_product)


# ---- silver and dimensions ----------------------------------------------------

def q_silver_customers(spark, sf):
    """Person-level dedup: the household identity maps many customer ids to one person."""
    b = tables.bronze_customers(spark, sf, identity="household")
    return without_stamps(cleaning.clean_customers(b))


def q_silver_orders(spark, sf):
    return without_stamps(cleaning.clean_orders(tables.bronze_orders(spark, sf)))


def q_orders_unparsed(spark, sf):
    return cleaning.unparsed_timestamps(tables.bronze_orders(spark, sf))


def q_silver_products(spark, sf):
    return without_stamps(cleaning.localize_products(tables.bronze_products(spark, sf),
                                                     tables.category_translation(spark)))


def q_silver_items(spark, sf):
    out = without_stamps(cleaning.clean_items(tables.bronze_order_items(spark, sf)))
    return _money_as_double(out, ["price", "freight_value", "discount"])


def q_dim_customer(spark, sf):
    return without_stamps(star_from_tables(spark, sf).dim_customer)


def q_dim_product(spark, sf):
    return without_stamps(star_from_tables(spark, sf).dim_product)


def q_customer_link_modes(spark, sf):
    """Fact size under both customer-link modes (household identity)."""
    parts = []
    for mode in ("deduped", "all_ids"):
        f = star_from_tables(spark, sf, identity="household", customer_link=mode).fact
        parts.append(f.agg(F.lit(mode).alias("customer_link"),
                           F.count(F.lit(1)).alias("fact_rows"),
                           F.count_distinct("order_id").alias("orders"),
                           F.count_distinct("customer_sk").alias("customers")))
    return parts[0].unionByName(parts[1])


def q_fact_all_ids(spark, sf):
    f = star_from_tables(spark, sf, identity="household", customer_link="all_ids").fact
    return _money_as_double(without_stamps(f), ["sales_amount", "freight_value"])


# ---- quality --------------------------------------------------------------------

def _ledger_out(df: DataFrame) -> DataFrame:
    return df.drop("audit_timestamp")


def q_dq_ledger(spark, sf):
    s = star_from_tables(spark, sf)
    return _ledger_out(quality.standard_suite(s.fact, s.dim_customer, s.dim_product, s.dim_date).ledger())


def q_dq_uniqueness(spark, sf):
    s = star_from_tables(spark, sf)
    v = quality.Validator()
    v.check_uniqueness(s.dim_customer, "customer_sk", "dim_customer")
    v.check_uniqueness(s.dim_product, "product_sk", "dim_product")
    v.check_uniqueness(s.dim_date, "date_sk", "dim_date")
    v.check_uniqueness(s.fact, ["order_id", "order_item_id"], "fact_sales")
    v.check_uniqueness(s.silver_customers, "customer_city", "silver_customers", severity="WARNING")
    return _ledger_out(v.ledger())


CALENDAR_PART = ("1996-03-01", "1998-08-31")   # ends amid the orders on both sides


def q_dq_orphans(spark, sf):
    """Orphans against a calendar that covers part of the orders, and against
    the products with a known category."""
    s = star_from_tables(spark, sf)
    v = quality.Validator()
    v.check_referential_integrity(s.fact, dims.dim_date(spark, *CALENDAR_PART), "order_date_sk", "date_sk",
                                  "fact_sales", "dim_date_part")
    known = s.dim_product.where(F.col("product_category_name") != "unknown")
    v.check_referential_integrity(s.fact, known, "product_sk", "product_sk", "fact_sales",
                                  "dim_product_known", severity="WARNING")
    v.check_referential_integrity(s.fact, s.dim_customer, "customer_sk", "customer_sk",
                                  "fact_sales", "dim_customer")
    return _ledger_out(v.ledger())


def q_duplicate_keys(spark, sf):
    return quality.duplicate_keys(star_from_tables(spark, sf).fact, ["order_id", "order_item_id"])


# ---- upsert ---------------------------------------------------------------------

UPSERT_TARGET_BEFORE = 20000101   # yesterday's load: orders before 2000
UPSERT_UPDATES_FROM = 19990101    # today's batch: orders from 1999 on, net of discount


def _renumbered_bronze(spark, sf, staging):
    """Raw roles with lines renumbered per order; the items are written once
    because several steps (key check, writes) read them."""
    bronze = tables.bronze_tables(spark, sf, renumber=True)
    bronze["order_items"] = staging.put(bronze["order_items"], "items")
    return bronze


def _upsert_inputs(spark, sf, staging):
    """Both are made from one copy of the fact's lines by natural keys."""
    s = star_from_bronze(spark, tables.bronze_tables(spark, sf, renumber=True))
    lines = fact_ops.fact_lines(s.silver_orders, s.silver_customers, s.silver_items)
    lines = staging.put(lines.select(*fact_ops.LINE_PARTS, "discount"), "lines")
    target = without_stamps(fact_ops.keyed_fact(lines)).where(F.col("order_date_sk") < UPSERT_TARGET_BEFORE)
    net = (F.col("price") * (F.lit(1) - F.col("discount"))).cast(MONEY)
    restated = fact_ops.keyed_fact(lines, sales_amount=net)
    updates = without_stamps(restated).where(F.col("order_date_sk") >= UPSERT_UPDATES_FROM)
    return target, updates


def _scratch(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _name(label):
    """A table name of this run alone."""
    return f"lodestar_{label}_{uuid.uuid4().hex[:12]}"


def _fact_upsert(spark, sf, runs):
    name, path = _name("fact"), _scratch(spark, "fact_upsert")
    with store.Staging(spark, "upsert_inputs") as staging:
        target, updates = _upsert_inputs(spark, sf, staging)
        upsert_ops.upsert(target, name, fact_ops.FACT_KEYS, path)
        out = None
        for _ in range(runs):
            out = upsert_ops.upsert(updates, name, fact_ops.FACT_KEYS, path)
    return _money_as_double(out, ["sales_amount", "freight_value"])


def _month(df):
    return df.withColumn("order_month", (F.col("order_date_sk") / 100).cast("int"))


def _partitioned(spark, sf, inputs, column):
    """What ``inputs`` makes of the target and the updates, upserted into a table partitioned by ``column``."""
    name, path = _name("fact"), _scratch(spark, "fact_upsert_partitioned")
    with store.Staging(spark, "upsert_inputs") as staging:
        target, updates = inputs(*_upsert_inputs(spark, sf, staging))
        upsert_ops.upsert_partitioned(target, name, fact_ops.FACT_KEYS, column, path)
        out = upsert_ops.upsert_partitioned(updates, name, fact_ops.FACT_KEYS, column)
    return _money_as_double(out, ["sales_amount", "freight_value"])


def q_fact_upsert_partitioned(spark, sf):
    """Same result; the table is partitioned by month and only touched months
    (including months a corrected row moves out of) are rewritten."""
    return _partitioned(spark, sf, lambda target, updates: (_month(target), _month(updates)), "order_month").drop("order_month")


def q_upsert_key_filter(spark, sf):
    """Finding what an upsert touches: target rows whose key has an update, that no such row is lost by the filter
    of update keys, and that it lets at most twice as many through."""
    keys = list(fact_ops.FACT_KEYS)
    with store.Staging(spark, "upsert_inputs") as staging:
        target, updates = _upsert_inputs(spark, sf, staging)
        one = store.stage(updates.where(F.col("order_date_sk").between(19990101, 19990131)), "updates")
        every = store.stage(target.select(*keys), "target")
    near = bloom.may_match(every, one.select(*keys), keys)
    matches = every.join(one.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("matches"))
    kept = near.join(one.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("kept"))
    passed = near.agg(F.count(F.lit(1)).alias("passed"))
    # Three rows of one count each.
    return matches.select("matches", (kept.scalar() == F.col("matches")).alias("none_lost"), (passed.scalar() <= 2 * F.col("matches")).alias("few_passed"))


def q_upsert_null_date(spark, sf):
    """Updates of every fifth order lose their date: its partition value is null."""
    gone = F.col("order_id").cast("long") % 5 == 0

    def inputs(target, updates):
        return _month(target), _month(updates.withColumn("order_date_sk", F.when(~gone, F.col("order_date_sk"))))

    return _partitioned(spark, sf, inputs, "order_month")


def q_upsert_text_partition(spark, sf):
    """Partition values are text with leading zeros."""
    month = F.lpad(((F.col("order_date_sk") / 100).cast("int") % 100).cast("string"), 2, "0")
    return _partitioned(spark, sf, lambda target, updates: (target.withColumn("month", month), updates.withColumn("month", month)), "month")


def q_upsert_new_column(spark, sf):
    """The updates bring a column that the table lacks."""
    note = F.concat(F.lit("net "), "order_id")
    return _partitioned(spark, sf, lambda target, updates: (_month(target), _month(updates).withColumn("note", note)), "order_month")


def q_upsert_missing_column(spark, sf):
    """The updates lack a column: matched rows keep its value, new rows have none."""
    return _partitioned(spark, sf, lambda target, updates: (_month(target), _month(updates.drop("freight_value"))), "order_month")


def q_upsert_moved_rows(spark, sf):
    """Corrections move all rows of one month to the next: the month is empty then."""
    def inputs(target, _):
        target = _month(target)
        return target, target.where("order_month = 199703").withColumn("order_month", F.lit(199704))

    return _partitioned(spark, sf, inputs, "order_month")


def q_fact_upsert(spark, sf):
    return _fact_upsert(spark, sf, 1)


def q_fact_upsert_twice(spark, sf):
    return _fact_upsert(spark, sf, 2)


# ---- named reads, guarded SQL, JSON ---------------------------------------------

def q_sales_summary(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "sales_summary")


def q_monthly_trends(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "monthly_trends", months=12)


def q_yoy_report(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "yoy_growth")


def q_top_customers(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "top_customers", limit=50)


def q_ltv_decile(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "top_customers", limit=500, decile=2)


def q_top_categories(spark, sf):
    return named.run_named(star_from_tables(spark, sf), "category_analysis", limit=20)


ADHOC_SQL = """
SELECT c.customer_city, d.calendar_year,
       COUNT(DISTINCT f.order_id) AS orders,
       CAST(ROUND(SUM(f.sales_amount), 2) AS DOUBLE) AS revenue
FROM lodestar_fact_sales f
JOIN lodestar_dim_customer c ON f.customer_sk = c.customer_sk
JOIN lodestar_dim_date d ON f.order_date_sk = d.date_sk
GROUP BY c.customer_city, d.calendar_year
"""


def q_adhoc_sql(spark, sf):
    sinks.publish_views(spark, star_from_tables(spark, sf).tables(), prefix="lodestar_")
    return sqlguard.read_only_sql(spark, ADHOC_SQL)


def q_sql_refused(spark, sf):
    """Queries held against the published names: rows of the accepted ones, null for the refused."""
    published = publish_star(spark, star_from_tables(spark, sf), "lodestar_")
    tables.read_table(spark, sf, "customer").createOrReplaceTempView("lodestar_private")
    cases = {
        "published view": "SELECT * FROM lodestar_monthly_sales",
        "published table in a subquery": "SELECT * FROM lodestar_dim_date WHERE date_sk IN (SELECT order_date_sk FROM lodestar_fact_sales)",
        "common table expression": "WITH m AS (SELECT * FROM lodestar_monthly_sales) SELECT * FROM m",
        "file by its path": f"SELECT * FROM parquet.`{sf}/customer.parquet`",
        "file in a subquery": f"SELECT 1 WHERE EXISTS (SELECT * FROM text.`{sf}/customer.parquet`)",
        "unpublished view": "SELECT * FROM lodestar_private",
        "unpublished view behind an inner name": "SELECT p.* FROM lodestar_private p, (WITH lodestar_private AS (SELECT 1) SELECT * FROM lodestar_private)",
    }
    rows = []
    for label, text in cases.items():
        try:
            rows.append((label, sqlguard.read_only_sql(spark, text, published=published).count()))
        except sqlguard.UnsafeSQLError:
            rows.append((label, None))
    return spark.createDataFrame(rows, "query string, row_count long")


def q_limits_refused(spark, sf):
    """Limits of the served reads: rows of those within the bounds, null for the refused."""
    star, rows = star_from_tables(spark, sf), []
    for read, argument, value in (("top_customers", "limit", 500), ("top_customers", "limit", 501), ("top_customers", "limit", 0),
                                  ("category_analysis", "limit", 101), ("category_analysis", "limit", 100), ("monthly_trends", "months", 61),
                                  ("monthly_trends", "months", 60)):
        try:
            rows.append((read, value, named.run_named(star, read, **{argument: value}).count()))
        except ValueError:
            rows.append((read, value, None))
    return spark.createDataFrame(rows, "query string, bound long, row_count long")


def q_view_scan_all(spark, sf):
    """All rows of a reporting view by its name."""
    publish_star(spark, star_from_tables(spark, sf), "lodestar_")
    return named.view_scan(spark, "lodestar_category_freight", 0)


def q_view_scan_limit(spark, sf):
    """A limited read by name; the limit is above the number of months, so the rows are fixed."""
    publish_star(spark, star_from_tables(spark, sf), "lodestar_")
    return named.view_scan(spark, "lodestar_monthly_sales", 500)


def q_view_sql(spark, sf):
    """Ad-hoc SQL over the reporting views."""
    publish_star(spark, star_from_tables(spark, sf), "lodestar_")
    return sqlguard.read_only_sql(spark, "SELECT ltv_decile, COUNT(*) AS customers, MAX(ltv_rank) AS last_rank, "
                                         "MAX(lifetime_value) AS top_value FROM lodestar_customer_ltv GROUP BY ltv_decile")


def q_list_tables(spark, sf):
    """The published names, each with the number of rows read through it."""
    publish_star(spark, star_from_tables(spark, sf), "lodestar_")
    wanted = ["fact_sales", "dim_customer", "dim_product", "dim_date", "monthly_sales", "customer_ltv"]
    listed = sinks.list_tables(spark, like="lodestar_*").select(F.col("tableName").alias("name"))
    counts = None
    for name in wanted:
        one = spark.table(f"lodestar_{name}").agg(F.lit(f"lodestar_{name}").alias("name"), F.count(F.lit(1)).alias("row_count"))
        counts = one if counts is None else counts.unionByName(one)
    return listed.join(counts, "name")


def q_result_json(spark, sf):
    """Rows as JSON; money as decimal text."""
    s = star_from_tables(spark, sf)
    out = views.monthly_sales(s.fact, s.dim_date, ordered=False)
    return rows_as_json(out.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("total_revenue", "total_freight_cost")}))


# ---- bad rows ---------------------------------------------------------------------

def _dirty_bronze(spark, sf):
    """The raw roles with null keys, malformed and padded text and duplicate lookup rows."""
    b = tables.bronze_tables(spark, sf, renumber=True)
    order, person = F.col("order_id").cast("long"), F.col("customer_id").cast("long")
    b["orders"] = b["orders"].withColumns({
        "order_purchase_timestamp": F.when(order % 7 == 0, F.lit("not a date")).when(order % 11 == 0, F.lit(None))
        .otherwise(F.concat(F.lit(" "), "order_purchase_timestamp", F.lit(" "))),
        "customer_id": F.when(order % 13 != 0, F.col("customer_id"))})
    b["customers"] = b["customers"].withColumns({
        "customer_city": F.when(person % 3 == 0, F.concat(F.lit("  "), F.lower("customer_city"), F.lit(" "))).otherwise(F.col("customer_city")),
        "customer_unique_id": F.when(person % 10 != 0, F.col("customer_unique_id"))})
    b["order_items"] = store.stage(b["order_items"].withColumn(
        "product_id", F.when(order % 17 != 0, F.col("product_id"))), "items")
    b["category_translation"] = b["category_translation"].union(b["category_translation"].select(
        "product_category_name", F.concat(F.lit("z "), "product_category_name_english")))
    return b


def q_silver_orders_dirty(spark, sf):
    return without_stamps(cleaning.clean_orders(_dirty_bronze(spark, sf)["orders"]))


def q_orders_unparsed_dirty(spark, sf):
    return cleaning.unparsed_timestamps(_dirty_bronze(spark, sf)["orders"])


def q_silver_customers_dirty(spark, sf):
    return without_stamps(cleaning.clean_customers(_dirty_bronze(spark, sf)["customers"]))


def q_silver_items_as_of(spark, sf):
    """Items with null products dropped, and the load stamp of a fixed time."""
    out = cleaning.clean_items(_dirty_bronze(spark, sf)["order_items"], as_of="2024-05-06 07:08:09")
    stamp = F.date_format("_updated_timestamp", "yyyy-MM-dd HH:mm:ss")
    return _money_as_double(out.withColumn("_updated_timestamp", stamp), ["price", "freight_value", "discount"])


def q_dq_ledger_dirty(spark, sf):
    s = star_from_bronze(spark, _dirty_bronze(spark, sf))
    return _ledger_out(quality.standard_suite(s.fact, s.dim_customer, s.dim_product, s.dim_date).ledger())


def q_dq_enforced(spark, sf):
    """The gate's outcome over the clean star and over the dirty one."""
    rows = []
    for label, bronze in (("clean", tables.bronze_tables(spark, sf, renumber=True)), ("dirty", _dirty_bronze(spark, sf))):
        s = star_from_bronze(spark, bronze)
        suite = quality.standard_suite(s.fact, s.dim_customer, s.dim_product, s.dim_date)
        try:
            rows.append((label, "passed", suite.enforce().count()))
        except quality.QualityGateError as e:
            rows.append((label, "refused", sum(r["status"] == "FAIL" for r in e.rows)))  # a row a check
    return spark.createDataFrame(rows, "star string, outcome string, checks long")


# ---- CSV, layout, whole run -----------------------------------------------------

def _items_csv(spark, sf):
    return tables.bronze_order_items(spark, sf).drop("discount")


def _csv(spark, df, name):
    folder = _scratch(spark, "csv")
    df.write.option("header", "true").option("compression", "gzip").csv(f"{folder}/{name}")
    return folder


def q_csv_roundtrip(spark, sf):
    """Items written as CSV, ingested back with the declared schema."""
    folder = _csv(spark, _items_csv(spark, sf), "order_items.csv")
    back = csv_source.ingest_csv(spark, f"{folder}/order_items.csv", schemas.ORDER_ITEMS)
    return _money_as_double(without_stamps(back), ["price", "freight_value"])


def q_csv_reordered(spark, sf):
    """The file's columns stand in another order than declared."""
    items = _items_csv(spark, sf)
    folder = _csv(spark, items.select(*reversed(items.columns)), "order_items.csv")
    back = csv_source.ingest_csv(spark, f"{folder}/order_items.csv", schemas.ORDER_ITEMS)
    return _money_as_double(without_stamps(back), ["price", "freight_value"])


def q_csv_two_headers(spark, sf):
    """A folder whose files hold the columns in different order, one of them with a further column."""
    items, folder = _items_csv(spark, sf), _scratch(spark, "csv")
    odd = F.col("order_item_id") % 2 == 1
    items.where(odd).write.option("header", "true").csv(f"{folder}/order_items.csv")
    late = items.where(~odd).withColumn("note", F.concat(F.lit("late, "), "order_id"))
    late.select(*reversed(late.columns)).write.option("header", "true").mode("append").csv(f"{folder}/order_items.csv")
    back = csv_source.ingest_csv(spark, f"{folder}/order_items.csv", schemas.ORDER_ITEMS)
    return _money_as_double(without_stamps(back), ["price", "freight_value"])


def q_csv_rejects(spark, sf):
    """Bad cells and a row of another length in a load: how many of each column were rejected, and what they held."""
    items, folder, prefix = _items_csv(spark, sf), _scratch(spark, "csv"), _name("m") + "_"
    order = F.col("order_id").cast("long")
    bad = items.withColumns({"price": F.when(order % 10 == 0, F.lit("12,50")).otherwise(F.col("price").cast("string")),
                             "order_item_id": F.when(order % 15 == 0, F.lit("first")).otherwise(F.col("order_item_id").cast("string"))})
    bad.write.option("header", "true").csv(f"{folder}/order_items.csv")
    short = items.select(F.concat_ws(",", "order_id", "order_item_id").alias("order_id,order_item_id,product_id,seller_id,price,freight_value"))
    short.where(order % 1000 == 1).write.option("header", "true").option("sep", "\t").mode("append").csv(f"{folder}/order_items.csv")
    csv_source.ingest_manifest(spark, folder, prefix, {"order_items.csv": ("items", schemas.ORDER_ITEMS)}, path=_scratch(spark, "bronze"))
    found = spark.table(f"{prefix}rejected_cells").where("table_name = 'items'")
    cell = F.when(F.col("column_name").isNotNull(), F.col("cell"))
    return found.groupBy("column_name", cell.alias("cell")).agg(F.count(F.lit(1)).alias("rejected"))


def q_csv_new_column(spark, sf):
    """A stored bronze table grows by a column that a later file brings."""
    items, name, path = _items_csv(spark, sf), _name("bronze"), _scratch(spark, "bronze")
    for df in (items, items.select(F.lit("2020-01-02").alias("shipping_limit_date"), *items.columns)):
        folder = _csv(spark, df, "order_items.csv")
        sinks.overwrite_evolving(without_stamps(csv_source.ingest_csv(spark, f"{folder}/order_items.csv", schemas.ORDER_ITEMS)), name, path)
    return _money_as_double(spark.table(name), ["price", "freight_value"])


def q_manifest_ingest(spark, sf):
    """All five files of a manifest; rows of each stored table."""
    b, folder, prefix = tables.bronze_tables(spark, sf), _scratch(spark, "csv"), _name("m") + "_"
    manifest = {}
    for role, df in b.items():
        df.write.option("header", "true").csv(f"{folder}/{role}.csv")
        manifest[f"{role}.csv"] = (role, df.schema)
    counts = None
    for table in csv_source.ingest_manifest(spark, folder, prefix, manifest, path=_scratch(spark, "bronze")):
        one = spark.table(table).agg(F.lit(table[len(prefix):]).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                     F.count("_load_timestamp").alias("stamped"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def q_schema_evolution(spark, sf):
    """Full refresh that drops a column: the table keeps it as a typed null."""
    items, name, path = tables.bronze_order_items(spark, sf), _name("evolve"), _scratch(spark, "evolve")
    sinks.overwrite_evolving(items, name, path)
    out = sinks.overwrite_evolving(items.drop("discount"), name, path)
    return _money_as_double(out, ["price", "freight_value", "discount"])


def q_zorder_layout(spark, sf):
    s = star_from_tables(spark, sf)
    lines = fact_ops.fact_lines(s.silver_orders, s.silver_customers, s.silver_items)
    # By natural keys, in a third of the bytes; the fact's keys are made when the lines are read.
    f = without_stamps(fact_ops.keyed_fact(store.stage(lines.select(*fact_ops.LINE_PARTS), "lines")))
    # The keys of a line take twice its other bytes, which the planner's estimate doesn't know.
    out = layout.cluster_by(f, pipeline.LAYOUT["fact_sales"], max(8, 3 * layout.partitions_for(f)))
    return _money_as_double(out, ["sales_amount", "freight_value"])


def q_zorder_skipping(spark, sf):
    """What the layout is for: of 64 partitions, those whose key ranges a lookup must read; and an even spread."""
    f = store.stage(without_stamps(star_from_tables(spark, sf).fact), "fact")
    keys = pipeline.LAYOUT["fact_sales"]
    out = layout.cluster_by(f, keys, 64).withColumn("_p", F.spark_partition_id())
    each = out.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), *[F.min(k).alias(f"lo_{k}") for k in keys], *[F.max(k).alias(f"hi_{k}") for k in keys])
    probe = f.agg(*[F.percentile(k, 0.5).cast("int").alias(k) if k == "order_date_sk" else F.max_by(k, F.xxhash64(k)).alias(k) for k in keys])
    each = each.crossJoin(F.broadcast(probe))  # one row
    read = [F.count_if((F.col(k) >= F.col(f"lo_{k}")) & (F.col(k) <= F.col(f"hi_{k}"))) for k in keys]
    return each.agg(F.sum("n").alias("row_count"), (F.max("n") <= 1.5 * F.avg("n")).alias("even"),
                    *[(r <= 40).alias(f"skips_{k}") for k, r in zip(keys, read)])


#: Lines of a folder of the table that is compacted: no file of it holds more than half of them.
FOLDER_LINES = 2_000_000


def q_compaction(spark, sf):
    """A fact whose folders hold two large and 24 small files: what is left of a folder after the small ones are merged.

    The folders follow the lines, one for each ``FOLDER_LINES``, so that no file
    and no task grows with the fact; one folder is the table's own.  Files are
    counted by folder, and folders that differ in what is left of them have a row
    each.
    """
    path, s = _scratch(spark, "compaction"), star_from_tables(spark, sf)
    lines = fact_ops.fact_lines(s.silver_orders, s.silver_customers, s.silver_items).select(*fact_ops.LINE_PARTS)
    folders = max(1, -(-lines.count() // FOLDER_LINES))
    late = F.col("order_id").cast("long") % 3 == 0

    def add(some, files):
        # Lines travel by natural keys, evenly dealt; each task writes one file.
        fact = without_stamps(fact_ops.keyed_fact(some.repartition(files * folders)))
        if folders > 1:
            fact = fact.withColumn("folder", F.floor(F.spark_partition_id() / files))
        fact.write.mode("append").partitionBy(*["folder"] if folders > 1 else []).parquet(path)
        return store.stage(compaction.listed(spark, path), "files")

    large, before = add(lines.where(~late), 2), add(lines.where(late), 24)
    target = int((large.agg(F.min("size")).first()[0] or 1) / compaction.SMALL)  # the large files are just not small
    done = compaction.compact(spark, path, target)
    steps = {"large": large, "before": before, "after": store.stage(compaction.listed(spark, path), "files")}
    found = reduce(DataFrame.unionByName, [f.withColumn("step", F.lit(k)) for k, f in steps.items()])
    files = found.groupBy("file").pivot("step", list(steps)).agg(F.max("size"))
    merged = F.when(F.col("after").isNull(), F.col("before"))
    kept = F.when(F.col("large").isNotNull(), F.col("large").eqNullSafe(F.col("after")))
    left = files.groupBy(_folder("file")).agg(
        F.count("before").cast("int").alias("files_before"), F.count(merged).cast("int").alias("files_merged"),
        F.count("after").alias("files_after"), F.bool_and(kept).alias("large_untouched"))
    told = left.agg(*[F.sum(c) for c in ("files_before", "files_after", "files_merged")]).first()
    if tuple(told) != (done.files_before, done.files_after, done.rewritten):
        raise RuntimeError(f"files of {path}: {told}, but the compaction tells {done}")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
    rows = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("sales_amount").alias("sales"))
    rows = rows.groupBy(_folder("file")).agg(F.sum("n").alias("n"), F.sum("sales").alias("sales"))
    return left.join(rows, "folder", "left").groupBy("files_before", "files_merged", (F.col("files_after") < 10).alias("few_after"), "large_untouched").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.sum("sales").cast("double").alias("sales")).select(
        "row_count", "sales", "files_before", "files_merged", "few_after", "large_untouched")


def _folder(file):
    return F.regexp_extract(F.col(file), "^(.*)/", 1).alias("folder")


def _pipeline_name(spark):
    return _name("gold"), _scratch(spark, "pipeline")


def q_pipeline_run(spark, sf):
    with store.Staging(spark, "bronze") as staging:
        res = pipeline.run_pipeline(spark, _renumbered_bronze(spark, sf, staging), *_pipeline_name(spark))
    return _ledger_out(res.ledger)


def q_pipeline_fact(spark, sf):
    """The published fact, read back after a run and a second one with corrected prices for part of the orders."""
    name, path = _pipeline_name(spark)
    with store.Staging(spark, "bronze") as staging:
        bronze = _renumbered_bronze(spark, sf, staging)
        pipeline.run_pipeline(spark, bronze, name, path)
        third = F.col("order_id").cast("long") % 3 == 0
        bronze["order_items"] = bronze["order_items"].where(third).withColumn("price", (F.col("price") * 2).cast(MONEY))
        pipeline.run_pipeline(spark, bronze, name, path)
    out = read_release(spark, name).fact
    return _money_as_double(without_stamps(out), ["sales_amount", "freight_value"])


def q_pipeline_incremental(spark, sf):
    """A second run with corrected lines of the orders of one month: what each month holds, and which months the run wrote.

    A month was written when its files lie under the second release's table.
    """
    name, path = _pipeline_name(spark)
    with store.Staging(spark, "bronze") as staging:
        bronze = _renumbered_bronze(spark, sf, staging)
        pipeline.run_pipeline(spark, bronze, name, path)
        orders = bronze["orders"].where(F.col("order_purchase_timestamp").startswith("1997-03")).select("order_id")
        bronze["order_items"] = bronze["order_items"].join(orders, "order_id", "left_semi").withColumn("price", (F.col("price") * 2).cast(MONEY))
        pipeline.run_pipeline(spark, bronze, name, path)
    fact = store.Releases(spark, name).read("fact_sales")
    written = F.contains(F.col("_metadata.file_path"), F.lit("fact_sales__r2/"))
    return fact.withColumn("written", written).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("sales_amount").cast("double").alias("sales"), F.max("written").alias("written"))


def _rolled(spark, sf):
    """Reports from monthly states, after a second release with dearer lines in one month and lines that moved to another.

    The correction doubles the prices of March 1997 and moves line 1 of that month's orders to April.
    """
    releases = store.Releases(spark, *_pipeline_name(spark))
    month = F.floor(F.col("order_date_sk") / 100).cast("int")
    first, second = releases.begin(), releases.begin() + 1
    with store.Staging(spark, "bronze") as staging:
        star = star_from_bronze(spark, _renumbered_bronze(spark, sf, staging))
        # Lines are dealt to their months by natural keys and get theirs where they are written.
        lines = fact_ops.fact_lines(star.silver_orders, star.silver_customers, star.silver_items).select(*fact_ops.LINE_PARTS)
        dealt = lines.withColumn("_month", F.floor(date_key("order_purchase_timestamp") / 100)).hint("rebalance", F.col("_month"))
        fact = fact_ops.keyed_fact(dealt).withColumn(pipeline.MONTH, month)
        fact = releases.save_partitioned(fact, "fact_sales", first, pipeline.MONTH, clustered=True)
    rollups.refresh(releases, first, None, [], pipeline.MONTH)
    march = fact.where(F.col(pipeline.MONTH) == 199703)
    moved = F.when(F.col("order_item_id") == 1, F.lit(19970415)).otherwise(F.col("order_date_sk"))
    updates = march.withColumn("sales_amount", (F.col("sales_amount") * 2).cast(MONEY)).withColumn("order_date_sk", moved)
    updates = updates.withColumn(pipeline.MONTH, month)
    months = [199703, 199704]
    changed = upsert_ops.merge_rows(fact.where(F.col(pipeline.MONTH).isin(months)), updates, fact_ops.FACT_KEYS)
    releases.save_partitioned(changed, "fact_sales", second, pipeline.MONTH, first, upsert_ops.as_text(months))
    rollups.refresh(releases, second, first, months, pipeline.MONTH)
    return star, rollups.Reports(releases, pipeline.MONTH, second)


def q_rollup_kpis(spark, sf):
    return _rolled(spark, sf)[1].executive_kpis()


def q_rollup_monthly_sales(spark, sf):
    star, reports = _rolled(spark, sf)
    return reports.monthly_sales(star.dim_date)


def q_rollup_yoy_growth(spark, sf):
    star, reports = _rolled(spark, sf)
    return reports.yoy_growth(star.dim_date)


def q_rollup_customer_ltv(spark, sf):
    return _rolled(spark, sf)[1].customer_ltv()


def q_rollup_category_freight(spark, sf):
    star, reports = _rolled(spark, sf)
    return reports.category_freight(star.dim_product)


def q_pipeline_bad_rows(spark, sf):
    """Bad rows in the second run: its ledger's failures, and the release that stays published."""
    name, path = _pipeline_name(spark)
    with store.Staging(spark, "bronze") as staging:
        pipeline.run_pipeline(spark, _renumbered_bronze(spark, sf, staging), name, path)
    try:
        pipeline.run_pipeline(spark, _dirty_bronze(spark, sf), name, path)
        refused = False
    except quality.QualityGateError:
        refused = True
    audit = spark.table(f"{name}__audit_log").where("status = 'FAIL'")
    return audit.select("table_name", "rule_type", "column_checked", "failing_record_count", F.lit(refused).alias("refused"),
                        F.lit(store.Releases(spark, name).current()).alias("published_release"))


QUERIES: dict[str, Query] = {
    "fact_build": q_fact_build,
    "dim_date": q_dim_date,
    "monthly_sales": q_monthly_sales,
    "executive_kpis": q_executive_kpis,
    "executive_kpis_split": q_executive_kpis_split,
    "executive_kpis_preagg": q_executive_kpis_preagg,
    "yoy_growth": q_yoy_growth,
    "customer_ltv": q_customer_ltv,
    "customer_ltv_window": q_customer_ltv_window,
    "customer_ltv_scaled": q_customer_ltv_scaled,
    "category_freight": q_category_freight,
    "silver_customers": q_silver_customers,
    "silver_orders": q_silver_orders,
    "orders_unparsed": q_orders_unparsed,
    "silver_products": q_silver_products,
    "silver_items": q_silver_items,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "customer_link_modes": q_customer_link_modes,
    "fact_all_ids": q_fact_all_ids,
    "dq_ledger": q_dq_ledger,
    "dq_uniqueness": q_dq_uniqueness,
    "dq_orphans": q_dq_orphans,
    "duplicate_keys": q_duplicate_keys,
    "fact_upsert": q_fact_upsert,
    "fact_upsert_twice": q_fact_upsert_twice,
    "fact_upsert_partitioned": q_fact_upsert_partitioned,
    "sales_summary": q_sales_summary,
    "monthly_trends": q_monthly_trends,
    "yoy_report": q_yoy_report,
    "top_customers": q_top_customers,
    "ltv_decile": q_ltv_decile,
    "top_categories": q_top_categories,
    "adhoc_sql": q_adhoc_sql,
    "result_json": q_result_json,
    "upsert_key_filter": q_upsert_key_filter,
    "upsert_null_date": q_upsert_null_date,
    "upsert_text_partition": q_upsert_text_partition,
    "upsert_new_column": q_upsert_new_column,
    "upsert_missing_column": q_upsert_missing_column,
    "upsert_moved_rows": q_upsert_moved_rows,
    "view_scan_all": q_view_scan_all,
    "view_scan_limit": q_view_scan_limit,
    "view_sql": q_view_sql,
    "list_tables": q_list_tables,
    "silver_orders_dirty": q_silver_orders_dirty,
    "orders_unparsed_dirty": q_orders_unparsed_dirty,
    "silver_customers_dirty": q_silver_customers_dirty,
    "silver_items_as_of": q_silver_items_as_of,
    "dq_ledger_dirty": q_dq_ledger_dirty,
    "dq_enforced": q_dq_enforced,
    "csv_reordered": q_csv_reordered,
    "csv_two_headers": q_csv_two_headers,
    "csv_rejects": q_csv_rejects,
    "sql_refused": q_sql_refused,
    "limits_refused": q_limits_refused,
    "csv_new_column": q_csv_new_column,
    "manifest_ingest": q_manifest_ingest,
    "zorder_skipping": q_zorder_skipping,
    "pipeline_fact": q_pipeline_fact,
    "pipeline_bad_rows": q_pipeline_bad_rows,
    "pipeline_incremental": q_pipeline_incremental,
    "rollup_kpis": q_rollup_kpis,
    "rollup_monthly_sales": q_rollup_monthly_sales,
    "rollup_yoy_growth": q_rollup_yoy_growth,
    "rollup_customer_ltv": q_rollup_customer_ltv,
    "rollup_category_freight": q_rollup_category_freight,
    "csv_roundtrip": q_csv_roundtrip,
    "schema_evolution": q_schema_evolution,
    "zorder_layout": q_zorder_layout,
    "compaction": q_compaction,
    "pipeline_run": q_pipeline_run,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
