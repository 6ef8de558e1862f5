"""DuckDB SQL equal to each registered query (the correctness oracle).

The tables of the driver are views in DuckDB.  The star is rebuilt here in
plain SQL from the same rules, written independently of the Spark code:
money in decimal, ``r2`` = round half-up to 2 places then double, ratios
divided as double and fixed to 10 decimals before rounding.
"""

from __future__ import annotations

from lodestar.sources.tables import CATEGORY_TRANSLATION_ROWS, LINE_ORDER


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


def _customer_uid(identity: str) -> str:
    if identity == "account":
        return "CAST(c_custkey AS VARCHAR)"
    return "concat_ws('-', CAST(c_nationkey AS VARCHAR), c_mktsegment)"


def _item_id(renumber: bool) -> str:
    if not renumber:
        return "l_linenumber"
    order = ", ".join(LINE_ORDER)
    return f"CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS INTEGER)"


def bronze_ctes(identity: str = "account", renumber: bool = False) -> list[str]:
    return [
        """bronze_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp
  FROM orders)""",
        f"""bronze_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, {_item_id(renumber)} AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS freight_value,
         CAST(l_discount AS DECIMAL(4,2)) AS discount
  FROM lineitem)""",
        f"""bronze_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, {_customer_uid(identity)} AS customer_unique_id,
         n_name AS customer_city, c_mktsegment AS customer_segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
        """bronze_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
         p_name AS product_name, p_brand AS product_brand, p_size AS product_size
  FROM part)""",
        f"""translation AS (
  SELECT * FROM (VALUES {_values(CATEGORY_TRANSLATION_ROWS)}) t(product_category_name, product_category_name_english))""",
    ]


def dirty_ctes() -> list[str]:
    """The raw roles with the bad rows of the dirty queries."""
    ctes = [c.replace(" AS (", "_raw AS (", 1) for c in bronze_ctes(renumber=True)]
    return ctes + [
        """bronze_orders AS (
  SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 13 <> 0 THEN customer_id END AS customer_id, order_status,
         CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN 'not a date' WHEN CAST(order_id AS BIGINT) % 11 = 0 THEN NULL
              ELSE ' ' || order_purchase_timestamp || ' ' END AS order_purchase_timestamp
  FROM bronze_orders_raw)""",
        """bronze_customers AS (
  SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 10 <> 0 THEN customer_unique_id END AS customer_unique_id,
         customer_city, customer_segment FROM bronze_customers_raw)""",
        """bronze_items AS (
  SELECT order_id, order_item_id, CASE WHEN CAST(order_id AS BIGINT) % 17 <> 0 THEN product_id END AS product_id,
         seller_id, price, freight_value, discount FROM bronze_items_raw)""",
        "bronze_products AS (SELECT * FROM bronze_products_raw)",
        "translation AS (SELECT * FROM translation_raw)",
    ]


SILVER_CTES = [
    """silver_customers AS (
  SELECT customer_id, customer_unique_id, lower(trim(customer_city)) AS customer_city, customer_segment
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY customer_id NULLS FIRST, customer_city NULLS FIRST, customer_segment NULLS FIRST) AS rn
        FROM bronze_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL) x
  WHERE rn = 1)""",
    """silver_orders AS (
  SELECT order_id, customer_id, order_status,
         TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp
  FROM bronze_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL)""",
    """lookup AS (
  SELECT product_category_name, min(product_category_name_english) AS product_category_name_english
  FROM translation WHERE product_category_name IS NOT NULL GROUP BY product_category_name)""",
    """silver_products AS (
  SELECT p.product_id, coalesce(l.product_category_name_english, 'unknown') AS product_category_name,
         p.product_name, p.product_brand, p.product_size
  FROM bronze_products p LEFT JOIN lookup l ON p.product_category_name = l.product_category_name
  WHERE p.product_id IS NOT NULL)""",
    """silver_items AS (
  SELECT * FROM bronze_items
  WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL)""",
]

GOLD_CTES = [
    """dim_customer AS (SELECT sha256(customer_unique_id) AS customer_sk, * FROM silver_customers)""",
    """dim_product AS (SELECT sha256(product_id) AS product_sk, * FROM silver_products)""",
    """cal_bounds AS (SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi FROM silver_orders)""",
    """cal_days AS (
  SELECT CAST(d AS DATE) AS calendar_date
  FROM cal_bounds, generate_series(CAST(make_date(year(lo), 1, 1) AS TIMESTAMP),
                                   CAST(make_date(year(hi), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY) g(d)
  WHERE lo IS NOT NULL)""",
    """dim_date AS (
  SELECT CAST(strftime(calendar_date, '%Y%m%d') AS INTEGER) AS date_sk, calendar_date,
         CAST(year(calendar_date) AS INTEGER) AS calendar_year,
         CAST(quarter(calendar_date) AS INTEGER) AS calendar_quarter,
         CAST(month(calendar_date) AS INTEGER) AS calendar_month,
         CAST(day(calendar_date) AS INTEGER) AS calendar_day,
         dayname(calendar_date) AS day_name
  FROM cal_days)""",
    """fact_sales AS (
  SELECT o.order_id, i.order_item_id, sha256(c.customer_unique_id) AS customer_sk,
         sha256(i.product_id) AS product_sk,
         CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_sk,
         i.price AS sales_amount, i.freight_value
  FROM silver_orders o
  JOIN silver_customers c ON o.customer_id = c.customer_id
  JOIN silver_items i ON o.order_id = i.order_id)""",
]


def with_star(body: str, identity: str = "account", extra: list[str] | None = None,
              renumber: bool = False, dirty: bool = False) -> str:
    bronze = dirty_ctes() if dirty else bronze_ctes(identity, renumber)
    ctes = bronze + SILVER_CTES + GOLD_CTES + (extra or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


def r2(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


def r2_ratio(num: str, den: str, scale: str | None = None) -> str:
    q = f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0.0))"
    if scale:
        q = f"({q} * {scale})"
    return f"CAST(ROUND(CAST({q} AS DECIMAL(38,10)), 2) AS DOUBLE)"


# ---- view bodies -------------------------------------------------------------

EXECUTIVE_KPIS = f"""
SELECT total_lifetime_orders, total_unique_customers,
       {r2('rev')} AS total_lifetime_revenue,
       {r2_ratio('rev', 'total_lifetime_orders')} AS average_order_value
FROM (SELECT COUNT(DISTINCT order_id) AS total_lifetime_orders,
             COUNT(DISTINCT customer_sk) AS total_unique_customers,
             SUM(sales_amount) AS rev
      FROM fact_sales) k"""

# Per day first, then the days of each month.
MONTHLY_SALES = f"""
SELECT y AS sales_year, m AS sales_month, orders AS total_orders, items AS total_items_sold,
       {r2('sales')} AS total_revenue, {r2('freight')} AS total_freight_cost
FROM (SELECT y, m, CAST(SUM(items) AS BIGINT) AS items, SUM(sales) AS sales, SUM(freight) AS freight
      FROM (SELECT order_date_sk, COUNT(order_item_id) AS items, SUM(sales_amount) AS sales, SUM(freight_value) AS freight
            FROM fact_sales GROUP BY order_date_sk) per_day
      JOIN (SELECT date_sk, calendar_year AS y, calendar_month AS m FROM dim_date) cal ON cal.date_sk = per_day.order_date_sk
      GROUP BY y, m) money
JOIN (SELECT calendar_year AS y, calendar_month AS m, COUNT(*) AS orders
      FROM (SELECT DISTINCT order_id, calendar_year, calendar_month
            FROM fact_sales JOIN dim_date ON date_sk = order_date_sk) u GROUP BY ALL) counted USING (y, m)"""

YOY_GROWTH = f"""
SELECT calendar_year, {r2('t')} AS current_revenue, {r2('p')} AS previous_year_revenue,
       {r2_ratio('t - p', 'p', '100')} AS yoy_growth_percentage
FROM (SELECT calendar_year, t, LAG(t) OVER (ORDER BY calendar_year) AS p
      FROM (SELECT d.calendar_year, SUM(f.sales_amount) AS t
            FROM fact_sales f JOIN dim_date d ON f.order_date_sk = d.date_sk
            GROUP BY d.calendar_year) y) z"""

CUSTOMER_LTV = f"""
SELECT customer_sk, total_orders, {r2('ltv')} AS lifetime_value,
       CAST(NTILE(10) OVER (ORDER BY ltv DESC, customer_sk) AS INTEGER) AS ltv_decile,
       CAST(DENSE_RANK() OVER (ORDER BY ltv DESC) AS INTEGER) AS ltv_rank
FROM (SELECT customer_sk, COUNT(DISTINCT order_id) AS total_orders, SUM(sales_amount) AS ltv
      FROM fact_sales GROUP BY customer_sk) m
WHERE ltv > 0"""

# Per product first, then the products of each known category.
CATEGORY_FREIGHT = f"""
SELECT category AS product_category_name, CAST(items AS BIGINT) AS items_sold,
       {r2('sales')} AS total_revenue, {r2('freight')} AS total_freight_cost,
       {r2_ratio('freight', 'sales', '100')} AS freight_to_revenue_ratio
FROM (SELECT category, SUM(items) AS items, SUM(sales) AS sales, SUM(freight) AS freight
      FROM (SELECT product_sk, COUNT(order_item_id) AS items, SUM(sales_amount) AS sales, SUM(freight_value) AS freight
            FROM fact_sales GROUP BY product_sk) per_product
      JOIN (SELECT product_sk, product_category_name AS category FROM dim_product
            WHERE product_category_name <> 'unknown') known USING (product_sk)
      GROUP BY category) totals
WHERE sales > 1000"""


# March 1997 with doubled prices and line 1 of each of its orders moved to April.
CORRECTED = """corrected AS (
  SELECT order_id, order_item_id, customer_sk, product_sk, freight_value,
         CASE WHEN order_date_sk // 100 = 199703 THEN sales_amount * 2 ELSE sales_amount END AS sales_amount,
         CASE WHEN order_date_sk // 100 = 199703 AND order_item_id = 1 THEN 19970415 ELSE order_date_sk END AS order_date_sk
  FROM fact_sales)"""


# ---- quality -------------------------------------------------------------------

def uniqueness_sql(table: str, keys: list[str], name: str, severity: str = "CRITICAL") -> str:
    k = ", ".join(keys)
    surplus = "COALESCE(SUM(n), 0) - COUNT(*)"
    return f"""SELECT '{name}' AS table_name, 'UNIQUENESS' AS rule_type, '{",".join(keys)}' AS column_checked,
       CAST({surplus} AS BIGINT) AS failing_record_count,
       CAST(COUNT(CASE WHEN n > 1 THEN 1 END) AS BIGINT) AS duplicate_key_count,
       CASE WHEN {surplus} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '{severity}' AS severity,
       CAST(NULL AS VARCHAR) AS reference_table
FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {k}) g"""


def orphans_sql(fact: str, fk: str, dim: str, pk: str, name: str, severity: str = "CRITICAL", dim_name: str = "") -> str:
    return f"""SELECT '{name}' AS table_name, 'REFERENTIAL_INTEGRITY' AS rule_type, '{fk}' AS column_checked,
       CAST(COUNT(*) AS BIGINT) AS failing_record_count, CAST(NULL AS BIGINT) AS duplicate_key_count,
       CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '{severity}' AS severity,
       '{dim_name or dim}' AS reference_table
FROM {fact} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"""


STANDARD_SUITE = "\nUNION ALL\n".join([
    uniqueness_sql("dim_customer", ["customer_sk"], "dim_customer"),
    uniqueness_sql("dim_product", ["product_sk"], "dim_product"),
    uniqueness_sql("dim_date", ["date_sk"], "dim_date"),
    orphans_sql("fact_sales", "customer_sk", "dim_customer", "customer_sk", "fact_sales"),
    orphans_sql("fact_sales", "product_sk", "dim_product", "product_sk", "fact_sales"),
    orphans_sql("fact_sales", "order_date_sk", "dim_date", "date_sk", "fact_sales"),
])

DQ_UNIQUENESS = "\nUNION ALL\n".join([
    uniqueness_sql("dim_customer", ["customer_sk"], "dim_customer"),
    uniqueness_sql("dim_product", ["product_sk"], "dim_product"),
    uniqueness_sql("dim_date", ["date_sk"], "dim_date"),
    uniqueness_sql("fact_sales", ["order_id", "order_item_id"], "fact_sales"),
    uniqueness_sql("silver_customers", ["customer_city"], "silver_customers", "WARNING"),
])

FIXED_CALENDAR = """dim_date_fixed AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk
  FROM generate_series(TIMESTAMP '1996-03-01', TIMESTAMP '1998-08-31', INTERVAL 1 DAY) g(d))"""
KNOWN_PRODUCTS = """dim_product_known AS (SELECT * FROM dim_product WHERE product_category_name != 'unknown')"""

DQ_ORPHANS = "\nUNION ALL\n".join([
    orphans_sql("fact_sales", "order_date_sk", "dim_date_fixed", "date_sk", "fact_sales", dim_name="dim_date_part"),
    orphans_sql("fact_sales", "product_sk", "dim_product_known", "product_sk", "fact_sales", "WARNING"),
    orphans_sql("fact_sales", "customer_sk", "dim_customer", "customer_sk", "fact_sales"),
])

# ---- customer link modes -----------------------------------------------------------

BRIDGE = """bridge AS (
  SELECT customer_id, min(customer_unique_id) AS customer_unique_id FROM bronze_customers
  WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL GROUP BY customer_id)"""
FACT_ALL_IDS = """fact_all_ids AS (
  SELECT o.order_id, i.order_item_id, sha256(b.customer_unique_id) AS customer_sk,
         sha256(i.product_id) AS product_sk,
         CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_sk,
         i.price AS sales_amount, i.freight_value
  FROM silver_orders o JOIN bridge b ON o.customer_id = b.customer_id
  JOIN silver_items i ON o.order_id = i.order_id)"""

LINK_MODES = """
SELECT 'deduped' AS customer_link, COUNT(*) AS fact_rows, COUNT(DISTINCT order_id) AS orders,
       COUNT(DISTINCT customer_sk) AS customers FROM fact_sales
UNION ALL
SELECT 'all_ids', COUNT(*), COUNT(DISTINCT order_id), COUNT(DISTINCT customer_sk) FROM fact_all_ids"""

FACT_OUT = """SELECT order_id, order_item_id, customer_sk, product_sk, order_date_sk,
       CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(freight_value AS DOUBLE) AS freight_value"""

# ---- upsert --------------------------------------------------------------------------

FACT_NET = """fact_net AS (
  SELECT o.order_id, i.order_item_id, sha256(c.customer_unique_id) AS customer_sk,
         sha256(i.product_id) AS product_sk,
         CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_sk,
         CAST(i.price * (1 - i.discount) AS DECIMAL(18,2)) AS sales_amount, i.freight_value
  FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id
  JOIN silver_items i ON o.order_id = i.order_id)"""
UPSERT = FACT_OUT + """
FROM (SELECT * FROM fact_sales t
      WHERE t.order_date_sk < 20000101
        AND NOT EXISTS (SELECT 1 FROM fact_net u
                        WHERE u.order_date_sk >= 19990101
                          AND u.order_id = t.order_id AND u.order_item_id = t.order_item_id)
      UNION ALL
      SELECT * FROM fact_net WHERE order_date_sk >= 19990101) x"""

# The same upsert, with a change to the update rows; {cols} beside the fact's columns.
MONTH = "CAST(floor(order_date_sk / 100) AS INTEGER)"


def upsert_sql(target_cols: str, update_cols: str, out: str, updates: str = "fact_net WHERE order_date_sk >= 19990101") -> str:
    return f"""SELECT {out} FROM (
  SELECT order_id, order_item_id, customer_sk, product_sk, order_date_sk, sales_amount, freight_value, {target_cols}
  FROM fact_sales t WHERE t.order_date_sk < 20000101
    AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM {updates}) u WHERE u.order_id = t.order_id AND u.order_item_id = t.order_item_id)
  UNION ALL
  SELECT order_id, order_item_id, customer_sk, product_sk, {update_cols} FROM {updates}) x"""


_OUT = """order_id, order_item_id, customer_sk, product_sk, order_date_sk,
       CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(freight_value AS DOUBLE) AS freight_value, """
_LOST = "CASE WHEN CAST(order_id AS BIGINT) % 5 <> 0 THEN order_date_sk END"
_TWO = "lpad(CAST(CAST(floor(order_date_sk / 100) AS INTEGER) % 100 AS VARCHAR), 2, '0')"
UPSERT_CASES = {
    "upsert_null_date": upsert_sql(f"{MONTH} AS order_month", f"{_LOST} AS order_date_sk, sales_amount, freight_value, CAST(floor({_LOST} / 100) AS INTEGER)",
                                   _OUT + "order_month"),
    "upsert_text_partition": upsert_sql(f"{_TWO} AS month", f"order_date_sk, sales_amount, freight_value, {_TWO}", _OUT + "month"),
    "upsert_new_column": upsert_sql(f"{MONTH} AS order_month, CAST(NULL AS VARCHAR) AS note",
                                    f"order_date_sk, sales_amount, freight_value, {MONTH}, 'net ' || order_id", _OUT + "order_month, note"),
    "upsert_missing_column": upsert_sql(
        f"{MONTH} AS order_month",
        f"order_date_sk, sales_amount, CASE WHEN order_date_sk < 20000101 THEN freight_value END, {MONTH}", _OUT + "order_month"),
    "upsert_moved_rows": FACT_OUT + f""", CASE WHEN {MONTH} = 199703 THEN 199704 ELSE {MONTH} END AS order_month
FROM fact_sales WHERE order_date_sk < 20000101""",
}

DIRTY_ITEMS = """SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, CAST(discount AS DOUBLE) AS discount,
       '2024-05-06 07:08:09' AS _updated_timestamp FROM silver_items"""
FAILED = f"(SELECT * FROM ({STANDARD_SUITE}) s WHERE status = 'FAIL')"
ENFORCED = f"""SELECT 'clean' AS star, 'passed' AS outcome, CAST(6 AS BIGINT) AS checks
UNION ALL SELECT 'dirty', 'refused', COUNT(*) FROM {FAILED} f"""
# The dirty run's fact over the clean run's: what the second ledger is about.
CLEAN_FACT = """clean_fact AS (
  SELECT o.order_id, i.order_item_id, sha256(c.customer_unique_id) AS customer_sk, sha256(i.product_id) AS product_sk,
         CAST(strftime(TRY_CAST(o.order_purchase_timestamp AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS order_date_sk
  FROM bronze_orders_raw o JOIN bronze_customers_raw c ON o.customer_id = c.customer_id JOIN bronze_items_raw i ON i.order_id = o.order_id)"""
MERGED_FACT = """merged_fact AS (
  SELECT * FROM clean_fact t WHERE NOT EXISTS (
    SELECT 1 FROM fact_sales u WHERE u.order_id = t.order_id AND u.order_item_id = t.order_item_id)
  UNION ALL SELECT order_id, order_item_id, customer_sk, product_sk, order_date_sk FROM fact_sales)"""
BAD_ROWS = "SELECT table_name, rule_type, column_checked, failing_record_count, true AS refused, 1 AS published_release FROM (" + \
    "\nUNION ALL\n".join(orphans_sql("merged_fact", fk, dim, pk, "fact_sales") for fk, dim, pk in [
        ("customer_sk", "dim_customer", "customer_sk"), ("product_sk", "dim_product", "product_sk"),
        ("order_date_sk", "dim_date", "date_sk")]) + ") s WHERE status = 'FAIL'"
ITEMS_OUT = """order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value"""
MONEY_TEXT = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
RESULT_JSON = f"""SELECT '{{"sales_year":' || sales_year || ',"sales_month":' || sales_month || ',"total_orders":' || total_orders
  || ',"total_items_sold":' || total_items_sold || ',"total_revenue":"' || {MONEY_TEXT.format('total_revenue')}
  || '","total_freight_cost":"' || {MONEY_TEXT.format('total_freight_cost')} || '"}}' AS json FROM ({MONTHLY_SALES}) v"""

ADHOC = f"""
SELECT c.customer_city, d.calendar_year, COUNT(DISTINCT f.order_id) AS orders,
       {r2('SUM(f.sales_amount)')} AS revenue
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
JOIN dim_date d ON f.order_date_sk = d.date_sk
GROUP BY c.customer_city, d.calendar_year"""


ORACLE_SQL: dict[str, str] = {
    "fact_build": with_star("""SELECT order_id, order_item_id, customer_sk, product_sk, order_date_sk,
       CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(freight_value AS DOUBLE) AS freight_value
FROM fact_sales"""),
    "dim_date": with_star("SELECT * FROM dim_date"),
    "monthly_sales": with_star(MONTHLY_SALES),
    "executive_kpis": with_star(EXECUTIVE_KPIS),
    "executive_kpis_split": with_star(EXECUTIVE_KPIS),
    "executive_kpis_preagg": with_star(EXECUTIVE_KPIS),
    "yoy_growth": with_star(YOY_GROWTH),
    "customer_ltv": with_star(CUSTOMER_LTV),
    "customer_ltv_window": with_star(CUSTOMER_LTV),
    "customer_ltv_scaled": with_star(CUSTOMER_LTV),
    "category_freight": with_star(CATEGORY_FREIGHT),
    "silver_customers": with_star("SELECT * FROM silver_customers", identity="household"),
    "silver_orders": with_star("SELECT * FROM silver_orders"),
    "orders_unparsed": with_star("""SELECT COUNT(CASE WHEN order_purchase_timestamp IS NOT NULL
    AND TRY_CAST(order_purchase_timestamp AS TIMESTAMP) IS NULL THEN 1 END) AS order_purchase_timestamp_nulled
FROM bronze_orders"""),
    "silver_products": with_star("SELECT * FROM silver_products"),
    "silver_items": with_star("""SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, CAST(discount AS DOUBLE) AS discount
FROM silver_items"""),
    "dim_customer": with_star("SELECT * FROM dim_customer"),
    "dim_product": with_star("SELECT * FROM dim_product"),
    "customer_link_modes": with_star(LINK_MODES, identity="household", extra=[BRIDGE, FACT_ALL_IDS]),
    "fact_all_ids": with_star(FACT_OUT + " FROM fact_all_ids", identity="household",
                              extra=[BRIDGE, FACT_ALL_IDS]),
    "dq_ledger": with_star(STANDARD_SUITE),
    "dq_uniqueness": with_star(DQ_UNIQUENESS),
    "dq_orphans": with_star(DQ_ORPHANS, extra=[FIXED_CALENDAR, KNOWN_PRODUCTS]),
    "duplicate_keys": with_star("""SELECT order_id, order_item_id, COUNT(*) AS row_count
FROM fact_sales GROUP BY order_id, order_item_id HAVING COUNT(*) > 1"""),
    "fact_upsert": with_star(UPSERT, extra=[FACT_NET], renumber=True),
    "fact_upsert_twice": with_star(UPSERT, extra=[FACT_NET], renumber=True),
    "fact_upsert_partitioned": with_star(UPSERT, extra=[FACT_NET], renumber=True),
    "sales_summary": with_star(EXECUTIVE_KPIS),
    "monthly_trends": with_star(f"SELECT * FROM ({MONTHLY_SALES}) v ORDER BY sales_year DESC, sales_month DESC LIMIT 12"),
    "yoy_report": with_star(YOY_GROWTH),
    "top_customers": with_star(f"SELECT * FROM ({CUSTOMER_LTV}) v ORDER BY ltv_rank, customer_sk LIMIT 50"),
    "ltv_decile": with_star(f"SELECT * FROM ({CUSTOMER_LTV}) v WHERE ltv_decile = 2 ORDER BY ltv_rank, customer_sk LIMIT 500"),
    "top_categories": with_star(f"SELECT * FROM ({CATEGORY_FREIGHT}) v ORDER BY freight_to_revenue_ratio DESC, product_category_name LIMIT 20"),
    "adhoc_sql": with_star(ADHOC),
    **{name: with_star(sql, extra=[FACT_NET], renumber=True) for name, sql in UPSERT_CASES.items()},
    "view_scan_all": with_star(CATEGORY_FREIGHT),
    "view_scan_limit": with_star(MONTHLY_SALES),
    "view_sql": with_star(f"""SELECT ltv_decile, COUNT(*) AS customers, MAX(ltv_rank) AS last_rank, MAX(lifetime_value) AS top_value
FROM ({CUSTOMER_LTV}) v GROUP BY ltv_decile"""),
    "list_tables": with_star(" UNION ALL ".join(
        f"SELECT 'lodestar_{n}' AS name, COUNT(*) AS row_count FROM {src}" for n, src in [
            ("fact_sales", "fact_sales"), ("dim_customer", "dim_customer"), ("dim_product", "dim_product"), ("dim_date", "dim_date"),
            ("monthly_sales", f"({MONTHLY_SALES}) a"), ("customer_ltv", f"({CUSTOMER_LTV}) b")])),
    "result_json": with_star(RESULT_JSON),
    "silver_orders_dirty": with_star("SELECT * FROM silver_orders", dirty=True),
    "orders_unparsed_dirty": with_star("""SELECT COUNT(CASE WHEN order_purchase_timestamp IS NOT NULL
    AND TRY_CAST(order_purchase_timestamp AS TIMESTAMP) IS NULL THEN 1 END) AS order_purchase_timestamp_nulled
FROM bronze_orders""", dirty=True),
    "silver_customers_dirty": with_star("SELECT * FROM silver_customers", dirty=True),
    "silver_items_as_of": with_star(DIRTY_ITEMS, dirty=True),
    "dq_ledger_dirty": with_star(STANDARD_SUITE, dirty=True),
    "dq_enforced": with_star(ENFORCED, dirty=True),
    "pipeline_bad_rows": with_star(BAD_ROWS, dirty=True, extra=[CLEAN_FACT, MERGED_FACT]),
    "csv_reordered": with_star(f"SELECT {ITEMS_OUT} FROM bronze_items"),
    "csv_new_column": with_star(f"SELECT {ITEMS_OUT}, '2020-01-02' AS shipping_limit_date FROM bronze_items"),
    "manifest_ingest": with_star(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS stamped FROM {t}" for n, t in [
            ("orders", "bronze_orders"), ("order_items", "bronze_items"), ("customers", "bronze_customers"),
            ("products", "bronze_products"), ("category_translation", "translation")])),
    "zorder_skipping": with_star("""SELECT CAST(COUNT(*) AS BIGINT) AS row_count, true AS even, true AS skips_order_date_sk,
       true AS skips_customer_sk, true AS skips_product_sk FROM fact_sales"""),
    "pipeline_fact": with_star(FACT_OUT.replace("CAST(sales_amount AS DOUBLE)",
        "CAST(CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN sales_amount * 2 ELSE sales_amount END AS DOUBLE)") + " FROM fact_sales", renumber=True),
    "pipeline_incremental": with_star("""SELECT order_date_sk // 100 AS order_month, COUNT(*) AS row_count,
       CAST(SUM(CASE WHEN order_date_sk // 100 = 199703 THEN sales_amount * 2 ELSE sales_amount END) AS DOUBLE) AS sales,
       order_date_sk // 100 = 199703 AS written FROM fact_sales GROUP BY order_date_sk // 100""", renumber=True),
    **{f"rollup_{name}": with_star(view.replace("fact_sales", "corrected"), extra=[CORRECTED], renumber=True) for name, view in {
        "kpis": EXECUTIVE_KPIS, "monthly_sales": MONTHLY_SALES, "yoy_growth": YOY_GROWTH, "customer_ltv": CUSTOMER_LTV,
        "category_freight": CATEGORY_FREIGHT}.items()},
    "compaction": with_star("""SELECT COUNT(*) AS row_count, CAST(SUM(sales_amount) AS DOUBLE) AS sales, 26 AS files_before, 24 AS files_merged,
       true AS few_after, true AS large_untouched FROM fact_sales"""),
    "upsert_key_filter": with_star("""SELECT COUNT(*) AS matches, true AS none_lost, true AS few_passed FROM fact_sales
WHERE order_date_sk BETWEEN 19990101 AND 19990131""", renumber=True),
    "csv_two_headers": with_star(f"""SELECT {ITEMS_OUT}, CASE WHEN order_item_id % 2 = 0 THEN 'late, ' || order_id END AS note FROM bronze_items"""),
    "csv_rejects": with_star("""SELECT 'price' AS column_name, '12,50' AS cell, COUNT(*) AS rejected FROM bronze_items WHERE CAST(order_id AS BIGINT) % 10 = 0
UNION ALL SELECT 'order_item_id', 'first', COUNT(*) FROM bronze_items WHERE CAST(order_id AS BIGINT) % 15 = 0
UNION ALL SELECT NULL, NULL, COUNT(*) FROM bronze_items WHERE CAST(order_id AS BIGINT) % 1000 = 1"""),
    "sql_refused": with_star(f"""SELECT 'published view' AS query, COUNT(*) AS row_count FROM ({MONTHLY_SALES}) v
UNION ALL SELECT 'published table in a subquery', COUNT(*) FROM dim_date WHERE date_sk IN (SELECT order_date_sk FROM fact_sales)
UNION ALL SELECT 'common table expression', COUNT(*) FROM ({MONTHLY_SALES}) v
UNION ALL SELECT unnest(['file by its path', 'file in a subquery', 'unpublished view', 'unpublished view behind an inner name']), NULL"""),
    "limits_refused": with_star(f"""SELECT 'top_customers' AS query, CAST(500 AS BIGINT) AS bound, LEAST(500, COUNT(*)) AS row_count FROM ({CUSTOMER_LTV}) v
UNION ALL SELECT 'top_customers', unnest([501, 0]), NULL
UNION ALL SELECT 'category_analysis', 101, NULL UNION ALL SELECT 'category_analysis', 100, LEAST(100, COUNT(*)) FROM ({CATEGORY_FREIGHT}) v
UNION ALL SELECT 'monthly_trends', 61, NULL UNION ALL SELECT 'monthly_trends', 60, LEAST(60, COUNT(*)) FROM ({MONTHLY_SALES}) v"""),
    "csv_roundtrip": with_star("""SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value FROM bronze_items"""),
    "schema_evolution": with_star("""SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, CAST(NULL AS DOUBLE) AS discount FROM bronze_items"""),
    "zorder_layout": with_star(FACT_OUT + " FROM fact_sales"),
    "pipeline_run": with_star(STANDARD_SUITE, renumber=True),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
