"""The logical input table: one row per order line."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Column order of the cleaned transactions table.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_date", T.DateType()),
    T.StructField("transaction_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit_cost", MONEY),
    T.StructField("total_cost", MONEY),
    T.StructField("sold_price", MONEY),
    T.StructField("gross_revenue", MONEY),
    T.StructField("refund_amount", MONEY),
    T.StructField("net_revenue", MONEY),
    T.StructField("gross_profit", MONEY),
    T.StructField("line_revenue", MONEY),
    T.StructField("returned_qty", T.DoubleType()),
    T.StructField("sold_price_level", T.IntegerType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
])

TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]

# --- fixed values that must equal the analysis definitions -------------------
# Order status kept by the approved-only analyses.
APPROVED = "Approved"
# Category groups used by the behavioural data mart.
FASHION_CATEGORIES = ["Dresses", "Tops", "Skirts", "Outerwear"]
ACCESSORY_CATEGORIES = ["Shoes", "Bags", "Accessories"]
CATEGORY_GROUPS = ["fashion", "accessory", "other"]
# ------------------------------------------------------------------------------
