"""Declared schemas of the raw (bronze) files.

Declaring the schema avoids the extra inference pass over each file and
keeps text keys such as zip prefixes as text (inference turns ``01310``
into ``1310``).
"""

from pyspark.sql.types import (DecimalType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

ORDERS = StructType([
    StructField("order_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("order_status", StringType()),
    StructField("order_purchase_timestamp", StringType()),
    StructField("order_approved_at", StringType()),
    StructField("order_delivered_carrier_date", StringType()),
    StructField("order_delivered_customer_date", StringType()),
    StructField("order_estimated_delivery_date", StringType()),
])

ORDER_ITEMS = StructType([
    StructField("order_id", StringType()),
    StructField("order_item_id", IntegerType()),
    StructField("product_id", StringType()),
    StructField("seller_id", StringType()),
    StructField("price", DecimalType(18, 2)),
    StructField("freight_value", DecimalType(18, 4)),
])

CUSTOMERS = StructType([
    StructField("customer_id", StringType()),
    StructField("customer_unique_id", StringType()),
    StructField("customer_zip_code_prefix", StringType()),
    StructField("customer_city", StringType()),
    StructField("customer_state", StringType()),
])

PRODUCTS = StructType([
    StructField("product_id", StringType()),
    StructField("product_category_name", StringType()),
    StructField("product_name_lenght", IntegerType()),
    StructField("product_description_lenght", IntegerType()),
    StructField("product_photos_qty", IntegerType()),
    StructField("product_weight_g", DoubleType()),
    StructField("product_length_cm", DoubleType()),
    StructField("product_height_cm", DoubleType()),
    StructField("product_width_cm", DoubleType()),
])

CATEGORY_TRANSLATION = StructType([
    StructField("product_category_name", StringType()),
    StructField("product_category_name_english", StringType()),
])

# File -> (table, schema): the ingest manifest of the five raw files.
MANIFEST = {
    "orders.csv": ("bronze_orders", ORDERS),
    "order_items.csv": ("bronze_order_items", ORDER_ITEMS),
    "customers.csv": ("bronze_customers", CUSTOMERS),
    "products.csv": ("bronze_products", PRODUCTS),
    "category_translation.csv": ("bronze_category_translation", CATEGORY_TRANSLATION),
}
