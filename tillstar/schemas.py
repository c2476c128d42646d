"""Fixed schemas of the feed, the star schema and the flat variant."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw headerless sales feed: seven positional columns, all scanned as text so
# that the corrupt-row verdict never depends on a type cast; the total is
# converted with try_cast afterwards.
RAW_COLUMNS = [
    "time_stamp",
    "store_name",
    "customer_name",
    "products",
    "total_price",
    "payment_type",
    "card_number",
]
CORRUPT_COL = "_corrupt_record"

RAW_ALL_STRING = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
RAW_SCAN = T.StructType(RAW_ALL_STRING.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])

# Length limits of the raw staging table (bytes).
RAW_LIMITS = {
    "time_stamp": 255,
    "store_name": 255,
    "customer_name": 255,
    "products": 1000,
    "payment_type": 255,
    "card_number": 255,
}
ITEM_LIMITS = {"product_name": 255, "flavour_name": 255}

PRICE = T.DecimalType(10, 2)

# Item CSV written with a header (transaction id, product, price, flavour).
ITEMS = T.StructType([
    T.StructField("transaction_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("price", PRICE, True),
    T.StructField("flavour", T.StringType(), True),
])

# Header feed of the local (flat) variant.
LOCAL_FEED = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("store", T.StringType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("basket_items", T.StringType(), True),
    T.StructField("total_price", T.DoubleType(), True),
    T.StructField("cash_or_card", T.StringType(), True),
    T.StructField("card_number", T.StringType(), True),
])

STORES = T.StructType([
    T.StructField("store_id", T.LongType(), False),
    T.StructField("store_name", T.StringType(), False),
])
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("store_id", T.LongType(), False),
])
PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("price", PRICE, False),
])
FLAVOURS = T.StructType([
    T.StructField("flavour_id", T.LongType(), False),
    T.StructField("flavour_name", T.StringType(), False),
])
TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("time_stamp", T.TimestampNTZType(), True),
    T.StructField("store_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("total_price", PRICE, False),
    T.StructField("payment_type", T.StringType(), False),
])
BASKETS = T.StructType([
    T.StructField("transaction_id", T.LongType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("flavour_id", T.LongType(), True),
])
QUARANTINE = T.StructType([
    T.StructField("reason", T.StringType(), False),
    T.StructField("line_md5", T.StringType(), True),
    T.StructField("file_path", T.StringType(), True),
    T.StructField("time_stamp", T.StringType(), True),
    T.StructField("store_name", T.StringType(), True),
    T.StructField("total_price", T.StringType(), True),
    T.StructField("payment_type", T.StringType(), True),
])
# Surrogate-id column of each id-bearing table.
ID_COLUMNS = {
    "stores": "store_id",
    "customers": "customer_id",
    "products": "product_id",
    "flavours": "flavour_id",
    "transactions": "transaction_id",
}
# One row per committed batch, with the attempt whose rows count.  The largest id of every table after the
# batch is kept here, so the next batch needs no scan of the tables for it;
# with dense ids 1..n it is also the exact row count of the table.
LEDGER = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("attempt", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("committed_at", T.TimestampType(), True),
] + [T.StructField(f"max_{c}", T.LongType(), True) for c in ID_COLUMNS.values()])

# Star schema in creation order (parents before children).
STAR_TABLES = {
    "products": PRODUCTS,
    "flavours": FLAVOURS,
    "stores": STORES,
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "baskets": BASKETS,
}

# Declared keys of the star schema (for the audits).
PRIMARY_KEYS = {
    "products": ["product_id"],
    "flavours": ["flavour_id"],
    "stores": ["store_id"],
    "customers": ["customer_id"],
    "transactions": ["transaction_id"],
}
UNIQUE_KEYS = {
    "products": ["product_name"],
    "flavours": ["flavour_name"],
    "stores": ["store_name"],
    "customers": ["customer_name", "store_id"],
}
NOT_NULL = {
    "products": ["product_id", "product_name", "price"],
    "flavours": ["flavour_id", "flavour_name"],
    "stores": ["store_id", "store_name"],
    "customers": ["customer_id", "customer_name", "store_id"],
    "transactions": ["transaction_id", "store_id", "customer_id", "total_price", "payment_type"],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("customers", "store_id", "stores", "store_id"),
    ("transactions", "store_id", "stores", "store_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("baskets", "transaction_id", "transactions", "transaction_id"),
    ("baskets", "product_id", "products", "product_id"),
    ("baskets", "flavour_id", "flavours", "flavour_id"),
]
