"""DuckDB oracle SQL for every registered query.

Each query is written independently of the Spark code, from the rules of the
feed and the load.  Shared pieces are CTE fragments composed below.  The
tables ``orders lineitem part customer nation events`` are views over the
same Parquet files.
"""

from __future__ import annotations

# ---------------------------------------------------------------- feed ----

ITEM_SQL = (
    "p.p_name || CASE WHEN p.p_size % 3 = 0 THEN '' ELSE ' - ' || p.p_type END"
    " || ' - ' || CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS VARCHAR)"
)

FEED = f"""
feed_items AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, {ITEM_SQL} AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
feed_baskets AS (
  SELECT l_orderkey, string_agg(item, ', ' ORDER BY l_linenumber, l_partkey, l_extendedprice) AS products
  FROM feed_items GROUP BY l_orderkey
),
raw_sales AS (
  SELECT o.o_orderkey,
    strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), '%d-%m-%Y %H:%M:%S') AS time_stamp,
    n.n_name AS store_name,
    c.c_name AS customer_name,
    b.products,
    CAST(CAST(o.o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS total_price,
    CASE WHEN o.o_orderkey % 2 = 0 THEN 'CARD' ELSE 'CASH' END AS payment_type,
    CASE WHEN o.o_orderkey % 2 = 0 THEN lpad(CAST(o.o_custkey AS VARCHAR), 16, '4') END AS card_number
  FROM orders o
  JOIN feed_baskets b ON b.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = (c.c_nationkey + o.o_orderkey % 2) % 25
)"""

# Staged (typed, pseudonymised) transactions of a feed CTE named {src}.
def staged(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT o_orderkey,
    strptime(time_stamp, '%d-%m-%Y %H:%M:%S') AS time_stamp,
    coalesce(store_name, '') AS store_name,
    md5(coalesce(customer_name, '')) AS customer_name,
    coalesce(products, '') AS products,
    CAST(total_price AS DECIMAL(10,2)) AS total_price,
    coalesce(payment_type, '') AS payment_type
  FROM {src}
)"""


def items_of(src: str, name: str) -> str:
    """Basket items of a staged CTE, one row per item with parts parsed."""
    return f"""
{name}_x AS (
  SELECT s.*, string_split(s.products, ', ') AS _items FROM {src} s
),
{name}_u AS (
  SELECT {name}_x.* EXCLUDE (_items),
    unnest(range(len(_items))) AS item_pos,
    unnest(_items) AS item
  FROM {name}_x
),
{name} AS (
  SELECT *, string_split(item, ' - ') AS _p FROM {name}_u
)"""


ITEM_COLS = (
    "_p[1] AS product_name, CASE WHEN len(_p) > 2 THEN _p[2] ELSE '' END AS flavour_name, "
    "TRY_CAST(_p[len(_p)] AS DECIMAL(10,2)) AS price"
)

WITH_FEED = "WITH " + FEED


def q_parse_items() -> str:
    return WITH_FEED + "," + staged("raw_sales", "st") + "," + items_of("st", "it") + f"""
SELECT o_orderkey, CAST(item_pos AS INTEGER) AS item_pos, {ITEM_COLS} FROM it"""


def q_explode_baskets() -> str:
    return WITH_FEED + "," + staged("raw_sales", "st") + "," + items_of("st", "it") + """
SELECT o_orderkey, CAST(item_pos AS INTEGER) AS item_pos, item FROM it"""


def q_stage_transactions() -> str:
    return WITH_FEED + "," + staged("raw_sales", "st") + """
SELECT time_stamp, store_name, customer_name, products, total_price, payment_type FROM st"""


# ---------------------------------------------------------------- load ----

def _empty(name: str, cols: str) -> str:
    return f"{name} AS (SELECT {cols} WHERE false)"


def load_ctes(filters: list[str], src: str = "raw_sales") -> str:
    """CTEs of an n-batch load of the feed; batch i keeps rows matching filters[i].

    Ids of new members continue after the largest id of the earlier batches,
    in natural-key order: stores by name, customers by (digest, store id),
    products and flavours by name, transactions by
    (time stamp, store, customer, total, payment, basket).
    """
    parts = [
        _empty("stores0", "CAST(NULL AS BIGINT) AS store_id, CAST(NULL AS VARCHAR) AS store_name"),
        _empty("customers0", "CAST(NULL AS BIGINT) AS customer_id, CAST(NULL AS VARCHAR) AS customer_name, CAST(NULL AS BIGINT) AS store_id"),
        _empty("products0", "CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS DECIMAL(10,2)) AS price"),
        _empty("flavours0", "CAST(NULL AS BIGINT) AS flavour_id, CAST(NULL AS VARCHAR) AS flavour_name"),
        _empty("txn0", "CAST(NULL AS BIGINT) AS transaction_id, CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS TIMESTAMP) AS time_stamp, "
               "CAST(NULL AS BIGINT) AS store_id, CAST(NULL AS BIGINT) AS customer_id, CAST(NULL AS DECIMAL(10,2)) AS total_price, "
               "CAST(NULL AS VARCHAR) AS payment_type, CAST(NULL AS VARCHAR) AS products"),
    ]
    for i, flt in enumerate(filters, 1):
        p = i - 1
        parts.append(f"rs{i} AS (SELECT * FROM {src} WHERE {flt})")
        parts.append(staged(f"rs{i}", f"st{i}").strip())
        parts.append(items_of(f"st{i}", f"si{i}").strip())
        parts.append(f"""stores_new{i} AS (
  SELECT CAST((SELECT coalesce(max(store_id), 0) FROM stores{p}) + row_number() OVER (ORDER BY store_name NULLS FIRST) AS BIGINT) AS store_id, store_name
  FROM (SELECT DISTINCT store_name FROM st{i} a WHERE NOT EXISTS (SELECT 1 FROM stores{p} b WHERE a.store_name = b.store_name)))""")
        parts.append(f"stores{i} AS (SELECT store_id, store_name FROM stores{p} UNION ALL SELECT store_id, store_name FROM stores_new{i})")
        parts.append(f"""customers_new{i} AS (
  SELECT CAST((SELECT coalesce(max(customer_id), 0) FROM customers{p}) + row_number() OVER (ORDER BY customer_name NULLS FIRST, store_id NULLS FIRST) AS BIGINT) AS customer_id,
    customer_name, store_id
  FROM (SELECT DISTINCT s.customer_name, d.store_id FROM st{i} s JOIN stores{i} d ON s.store_name = d.store_name) a
  WHERE NOT EXISTS (SELECT 1 FROM customers{p} b WHERE a.customer_name = b.customer_name AND a.store_id = b.store_id))""")
        parts.append(f"customers{i} AS (SELECT customer_id, customer_name, store_id FROM customers{p} UNION ALL SELECT customer_id, customer_name, store_id FROM customers_new{i})")
        parts.append(f"""products_new{i} AS (
  SELECT CAST((SELECT coalesce(max(product_id), 0) FROM products{p}) + row_number() OVER (ORDER BY product_name NULLS FIRST) AS BIGINT) AS product_id, product_name, price
  FROM (SELECT product_name, min(price) AS price FROM (SELECT {ITEM_COLS} FROM si{i}) GROUP BY product_name) a
  WHERE NOT EXISTS (SELECT 1 FROM products{p} b WHERE a.product_name = b.product_name))""")
        parts.append(f"products{i} AS (SELECT product_id, product_name, price FROM products{p} UNION ALL SELECT product_id, product_name, price FROM products_new{i})")
        parts.append(f"""flavours_new{i} AS (
  SELECT CAST((SELECT coalesce(max(flavour_id), 0) FROM flavours{p}) + row_number() OVER (ORDER BY flavour_name NULLS FIRST) AS BIGINT) AS flavour_id, flavour_name
  FROM (SELECT DISTINCT flavour_name FROM (SELECT {ITEM_COLS} FROM si{i})) a
  WHERE NOT EXISTS (SELECT 1 FROM flavours{p} b WHERE a.flavour_name = b.flavour_name))""")
        parts.append(f"flavours{i} AS (SELECT flavour_id, flavour_name FROM flavours{p} UNION ALL SELECT flavour_id, flavour_name FROM flavours_new{i})")
        parts.append(f"""txn_new{i} AS (
  SELECT CAST((SELECT coalesce(max(transaction_id), 0) FROM txn{p}) + row_number() OVER (
      ORDER BY time_stamp NULLS FIRST, store_id NULLS FIRST, customer_id NULLS FIRST, total_price NULLS FIRST,
               payment_type NULLS FIRST, products NULLS FIRST) AS BIGINT) AS transaction_id,
    o_orderkey, time_stamp, store_id, customer_id, total_price, payment_type, products
  FROM (SELECT s.o_orderkey, s.time_stamp, d.store_id, c.customer_id, s.total_price, s.payment_type, s.products
        FROM st{i} s JOIN stores{i} d ON s.store_name = d.store_name
        JOIN customers{i} c ON c.customer_name = s.customer_name AND c.store_id = d.store_id))""")
        parts.append(f"txn{i} AS (SELECT * FROM txn{p} UNION ALL SELECT * FROM txn_new{i})")
    n = len(filters)
    parts.append(items_of(f"txn{n}", "ti").strip())
    parts.append(f"""baskets AS (
  SELECT x.transaction_id, pr.product_id, fl.flavour_id
  FROM (SELECT transaction_id, {ITEM_COLS} FROM ti) x
  LEFT JOIN products{n} pr ON pr.product_name = x.product_name
  LEFT JOIN flavours{n} fl ON fl.flavour_name = x.flavour_name)""")
    parts.append(f"stores AS (SELECT * FROM stores{n})")
    parts.append(f"customers AS (SELECT * FROM customers{n})")
    parts.append(f"products AS (SELECT * FROM products{n})")
    parts.append(f"flavours AS (SELECT * FROM flavours{n})")
    parts.append(f"transactions AS (SELECT transaction_id, time_stamp, store_id, customer_id, total_price, payment_type FROM txn{n})")
    return WITH_FEED + ",\n" + ",\n".join(parts)


ONE_BATCH = ["true"]
TWO_BATCHES = ["o_orderkey < 10", "o_orderkey >= 10"]

STAR_SELECT = """
SELECT t.transaction_id, t.time_stamp, t.store_id, t.customer_id, t.total_price, t.payment_type, b.product_id, b.flavour_id
FROM transactions t JOIN baskets b ON b.transaction_id = t.transaction_id"""


def q_load(filters: list[str], select: str) -> str:
    return load_ctes(filters) + "\n" + select


def load_sql() -> dict[str, str]:
    st1 = staged("raw_sales", "stx")
    return {
        "star_load": q_load(ONE_BATCH, STAR_SELECT),
        "star_load_two_batches": q_load(TWO_BATCHES, STAR_SELECT),
        "stream_ingest": q_load(TWO_BATCHES, STAR_SELECT),
        "replay_is_idempotent": q_load(TWO_BATCHES, STAR_SELECT),
        "fact_transactions": q_load(ONE_BATCH, "SELECT * FROM transactions"),
        "basket_lines": q_load(ONE_BATCH, "SELECT * FROM baskets"),
        "dim_stores_incremental": q_load(TWO_BATCHES, "SELECT * FROM stores"),
        "dim_customers_incremental": q_load(TWO_BATCHES, "SELECT * FROM customers"),
        "dim_products_incremental": q_load(TWO_BATCHES, "SELECT * FROM products"),
        "dim_flavours_incremental": q_load(TWO_BATCHES, "SELECT * FROM flavours"),
        "distinct_stores": WITH_FEED + "," + st1 + "\nSELECT DISTINCT store_name FROM stx",
        "distinct_customers": WITH_FEED + "," + st1 + "\nSELECT DISTINCT customer_name, store_name FROM stx",
        "distinct_products": WITH_FEED + "," + st1 + "," + items_of("stx", "ix")
        + f"\nSELECT DISTINCT product_name, price FROM (SELECT {ITEM_COLS} FROM ix)",
        "distinct_flavours": WITH_FEED + "," + st1 + "," + items_of("stx", "ix")
        + f"\nSELECT DISTINCT flavour_name FROM (SELECT {ITEM_COLS} FROM ix)",
        "lookup_store": q_load(ONE_BATCH, """
SELECT s.time_stamp, s.store_name, d.store_id, s.customer_name, s.total_price, s.payment_type
FROM st1 s LEFT JOIN stores d ON d.store_name = s.store_name"""),
        "lookup_customer": q_load(ONE_BATCH, """
SELECT s.time_stamp, d.store_id, s.customer_name, c.customer_id, s.total_price, s.payment_type
FROM st1 s LEFT JOIN stores d ON d.store_name = s.store_name
LEFT JOIN customers c ON c.customer_name = s.customer_name AND c.store_id = d.store_id"""),
        "lookup_customer_by_name": q_load(ONE_BATCH, """
SELECT s.time_stamp, d.store_id, s.customer_name, c.customer_id, s.total_price, s.payment_type
FROM st1 s LEFT JOIN stores d ON d.store_name = s.store_name
LEFT JOIN (SELECT customer_name, min(customer_id) AS customer_id FROM customers GROUP BY customer_name) c
  ON c.customer_name = s.customer_name"""),
        "transaction_id_backfill": q_load(ONE_BATCH, """
SELECT s.time_stamp, s.store_id, s.customer_id, s.total_price, s.payment_type, k.transaction_id
FROM (SELECT x.time_stamp, d.store_id, c.customer_id, x.total_price, x.payment_type
      FROM st1 x LEFT JOIN stores d ON d.store_name = x.store_name
      LEFT JOIN customers c ON c.customer_name = x.customer_name AND c.store_id = d.store_id) s
LEFT JOIN (SELECT time_stamp, store_id, customer_id, total_price, payment_type, min(transaction_id) AS transaction_id
           FROM transactions GROUP BY ALL) k
  ON k.time_stamp = s.time_stamp AND k.store_id = s.store_id AND k.customer_id = s.customer_id
 AND k.total_price = s.total_price AND k.payment_type = s.payment_type"""),
    }


# ------------------------------------------------------- csv and audits ----

DIRTY = """,
dirty AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 101 = 7 THEN '31-02' || substr(time_stamp, 6) ELSE time_stamp END AS time_stamp,
    CASE WHEN o_orderkey % 113 = 19 THEN store_name || repeat('#', 250) ELSE store_name END AS store_name,
    customer_name,
    CASE WHEN o_orderkey % 107 = 13 THEN products || ', Water' ELSE products END AS products,
    CASE WHEN o_orderkey % 103 = 11 THEN 'xx' ELSE total_price END AS total_price,
    payment_type, card_number,
    o_orderkey % 109 = 17 AS is_corrupt
  FROM raw_sales
),
scanned AS (
  SELECT time_stamp, store_name,
    CASE WHEN is_corrupt THEN NULL ELSE customer_name END AS customer_name,
    CASE WHEN is_corrupt THEN NULL ELSE products END AS products,
    CASE WHEN is_corrupt THEN NULL ELSE total_price END AS total_price,
    CASE WHEN is_corrupt THEN NULL ELSE payment_type END AS payment_type,
    CASE WHEN is_corrupt THEN NULL ELSE card_number END AS card_number,
    is_corrupt
  FROM dirty
)"""

REASON_SQL = """CASE
    WHEN is_corrupt THEN 'corrupt_row'
    WHEN try_strptime(coalesce(time_stamp, ''), '%d-%m-%Y %H:%M:%S') IS NULL THEN 'bad_timestamp'
    WHEN TRY_CAST(coalesce(total_price, '') AS DECIMAL(10,2)) IS NULL THEN 'bad_total'
    WHEN list_bool_or(list_transform(string_split(coalesce(products, ''), ', '),
           lambda x: TRY_CAST(string_split(x, ' - ')[-1] AS DECIMAL(10,2)) IS NULL)) THEN 'bad_price'
    WHEN strlen(coalesce(time_stamp, '')) > 255 OR strlen(coalesce(store_name, '')) > 255
      OR strlen(coalesce(customer_name, '')) > 255 OR strlen(coalesce(products, '')) > 1000
      OR strlen(coalesce(payment_type, '')) > 255 OR strlen(coalesce(card_number, '')) > 255
      OR list_bool_or(list_transform(string_split(coalesce(products, ''), ', '),
           lambda x: strlen(string_split(x, ' - ')[1]) > 255 OR strlen(coalesce(string_split(x, ' - ')[2], '')) > 255))
      THEN 'too_long'
    ELSE 'ok' END"""

LIMITS = [("time_stamp", 255), ("store_name", 255), ("customer_name", 255), ("products", 1000),
          ("payment_type", 255), ("card_number", 255)]

NOT_NULL_SQL = {
    "products": ["product_id", "product_name", "price"],
    "flavours": ["flavour_id", "flavour_name"],
    "stores": ["store_id", "store_name"],
    "customers": ["customer_id", "customer_name", "store_id"],
    "transactions": ["transaction_id", "store_id", "customer_id", "total_price", "payment_type"],
}
KEYS_SQL = [
    ("products", ["product_id"]), ("flavours", ["flavour_id"]), ("stores", ["store_id"]),
    ("customers", ["customer_id"]), ("transactions", ["transaction_id"]),
    ("products", ["product_name"]), ("flavours", ["flavour_name"]), ("stores", ["store_name"]),
    ("customers", ["customer_name", "store_id"]),
]
FKS_SQL = [
    ("customers", "store_id", "stores", "store_id"),
    ("transactions", "store_id", "stores", "store_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("baskets", "transaction_id", "transactions", "transaction_id"),
    ("baskets", "product_id", "products", "product_id"),
    ("baskets", "flavour_id", "flavours", "flavour_id"),
]


def csv_sql() -> dict[str, str]:
    nulls = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM {t}"
        for t, cols in NOT_NULL_SQL.items() for c in cols
    )
    dups = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{','.join(k)}' AS key_columns, concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in k)}) AS key_value, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM {t} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in k)} GROUP BY ALL HAVING count(*) > 1"
        for t, k in KEYS_SQL
    )
    orphans = " UNION ALL ".join(
        f"SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, "
        f"CAST(count(*) AS BIGINT) AS n_orphans FROM {c} x WHERE x.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pc} = x.{cc})"
        for c, cc, p, pc in FKS_SQL
    )
    lengths = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({n} AS INTEGER) AS max_bytes, CAST(count(*) FILTER (WHERE strlen({c}) > {n}) AS BIGINT) AS n_over FROM scanned"
        for c, n in LIMITS
    )
    conflicts = (
        "," + staged("raw_sales", "stq").strip() + ",\n" + items_of("stq", "iq").strip()
    )
    return {
        "scan_raw_csv": WITH_FEED + DIRTY + "\nSELECT * FROM scanned",
        "quarantine_reasons": WITH_FEED + DIRTY + f"\nSELECT reason, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT {REASON_SQL} AS reason FROM scanned) GROUP BY reason",
        "quarantine_rows": WITH_FEED + DIRTY.replace("o_orderkey % 109 = 17 AS is_corrupt", "o_orderkey % 109 = 17 OR o_orderkey % 97 IN (3, 5, 7) AS is_corrupt") + f"""
SELECT reason,
  CASE WHEN reason NOT IN ('corrupt_row', 'bad_timestamp') THEN strftime(strptime(time_stamp, '%d-%m-%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS time_stamp,
  CAST(NULL AS VARCHAR) AS store_name,
  CASE WHEN reason <> 'corrupt_row' THEN CAST(TRY_CAST(total_price AS DECIMAL(10,2)) AS VARCHAR) END AS total_price,
  CASE WHEN reason <> 'corrupt_row' THEN payment_type END AS payment_type
FROM (SELECT *, {REASON_SQL} AS reason FROM scanned) WHERE reason <> 'ok'""",
        "quality_length": WITH_FEED + DIRTY + "\n" + lengths,
        "quality_nulls": q_load(ONE_BATCH, nulls),
        "quality_orphans": q_load(ONE_BATCH, orphans),
        "quality_duplicates": load_ctes(ONE_BATCH) + conflicts + "\n" + dups + f"""
UNION ALL
SELECT 'item_staging' AS table_name, 'product_name' AS key_columns, product_name AS key_value,
  CAST(count(DISTINCT price) AS BIGINT) AS n_rows
FROM (SELECT {ITEM_COLS} FROM iq) GROUP BY product_name HAVING count(DISTINCT price) > 1""",
        "items_csv_roundtrip": q_load(ONE_BATCH, f"""
SELECT transaction_id, product_name, price, flavour_name AS flavour FROM (SELECT transaction_id, {ITEM_COLS} FROM ti)"""),
        "stream_archive": WITH_FEED + """
SELECT time_stamp, store_name, products, total_price, payment_type FROM raw_sales""",
        "scan_header_csv": WITH_FEED + """
SELECT time_stamp AS "timestamp", store_name AS store, customer_name, products AS basket_items,
  CAST(total_price AS DOUBLE) AS total_price, payment_type AS cash_or_card, card_number
FROM raw_sales""",
    }


# ------------------------------------------------------------ flat variant --

FLAT = """,
lf AS (
  SELECT o_orderkey, time_stamp AS ts_text, store_name AS store, customer_name, products AS basket_items,
    CAST(total_price AS DOUBLE) AS total_price, payment_type
  FROM raw_sales
),
fx AS (SELECT lf.*, string_split(basket_items, ',') AS _b FROM lf WHERE basket_items IS NOT NULL),
fu AS (SELECT fx.* EXCLUDE (_b), unnest(range(len(_b))) AS item_pos, unnest(_b) AS product FROM fx),
fp AS (SELECT *, string_split(ltrim(product), '-') AS a FROM fu),
fh AS (SELECT *, a[1:len(a) - 1] AS head, a[len(a)] AS price FROM fp),
fi AS (SELECT *, CASE WHEN len(head) < 2 THEN list_append(head, ' ') ELSE head END AS h2 FROM fh),
f0 AS (SELECT *, h2[1] AS item, h2[len(h2)] AS flavour FROM fi),
flat AS (
  SELECT o_orderkey, CAST(item_pos AS INTEGER) AS item_pos,
    CAST(dense_rank() OVER (ORDER BY ts_text) - 1 AS BIGINT) AS transactions_id,
    ts_text AS time_stamp,
    CAST(dense_rank() OVER (ORDER BY store) - 1 AS BIGINT) AS store_id, store,
    CAST(dense_rank() OVER (ORDER BY customer_name) - 1 AS BIGINT) AS customer_id, customer_name,
    total_price, payment_type,
    CAST(dense_rank() OVER (ORDER BY item) - 1 AS BIGINT) AS item_id, item,
    CAST(dense_rank() OVER (ORDER BY flavour) - 1 AS BIGINT) AS flavour_id, flavour,
    price
  FROM f0
),
first_rows AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY o_orderkey, item_pos) AS rn_item,
            row_number() OVER (PARTITION BY transactions_id ORDER BY o_orderkey, item_pos) AS rn_txn,
            row_number() OVER (PARTITION BY customer_name ORDER BY o_orderkey, item_pos) AS rn_cust
  FROM flat
)"""


def flat_sql() -> dict[str, str]:
    base = WITH_FEED + FLAT
    return {
        "flat_frame": base + """
SELECT transactions_id, time_stamp, store_id, store, customer_id, customer_name, total_price, payment_type,
  item_id, item, flavour_id, flavour, price FROM flat""",
        "group_numbers": base + """
SELECT DISTINCT 'time_stamp' AS key_kind, time_stamp AS key_value, transactions_id AS group_no FROM flat
UNION ALL SELECT DISTINCT 'store', store, store_id FROM flat
UNION ALL SELECT DISTINCT 'customer_name', customer_name, customer_id FROM flat
UNION ALL SELECT DISTINCT 'item', item, item_id FROM flat
UNION ALL SELECT DISTINCT 'flavour', flavour, flavour_id FROM flat""",
        "flat_tables_products": base + """
SELECT item_id AS product_id, item AS product_name, TRY_CAST(trim(price) AS DECIMAL(10,2)) AS price
FROM first_rows WHERE rn_item = 1""",
        "flat_tables_sales": base + """
SELECT transactions_id, strptime(time_stamp, '%d-%m-%Y %H:%M:%S') AS time_stamp, store_id, customer_id, total_price
FROM first_rows WHERE rn_txn = 1""",
        "flat_tables_orders": base + """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey, item_pos) AS BIGINT) AS order_id,
  item_id AS product_id, flavour_id, transactions_id FROM flat""",
        "flat_tables_customers": base + """
SELECT DISTINCT customer_id, customer_name FROM flat""",
        "flat_tables_stores": base + """
SELECT DISTINCT store_id, store AS store_name FROM flat""",
        "flat_tables_flavours": base + """
SELECT DISTINCT flavour_id, flavour FROM flat""",
        "flat_tables_published": base + """
SELECT 'customers' AS table_name, count(DISTINCT customer_id) AS n_rows FROM flat
UNION ALL SELECT 'stores', count(DISTINCT store_id) FROM flat
UNION ALL SELECT 'products', count(DISTINCT item_id) FROM flat
UNION ALL SELECT 'flavours', count(DISTINCT flavour_id) FROM flat
UNION ALL SELECT 'sales', count(DISTINCT transactions_id) FROM flat
UNION ALL SELECT 'orders', count(*) FROM flat""",
        "insert_or_fail": "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "insert_ignore": base + """
SELECT customer_id, customer_name FROM first_rows WHERE rn_cust = 1""",
    }


# ------------------------------------------------- rows and column types ----

PART_RANGE = """
WITH pr AS (
  SELECT p_partkey, p_partkey % 6 AS kind, CAST(p_size AS BIGINT) AS lo, CAST(p_size + 1 + p_partkey % 7 AS BIGINT) AS hi
  FROM part
), rg AS (
  SELECT p_partkey, kind, lo, hi,
    CASE WHEN kind IN (0, 1, 2, 5) THEN lo END AS lower,
    CASE WHEN kind IN (0, 1, 3, 5) THEN hi END AS upper,
    CASE kind WHEN 0 THEN '[)' WHEN 1 THEN '(]' WHEN 2 THEN '[)' WHEN 3 THEN '()' WHEN 5 THEN '[]' END AS bounds
  FROM pr
)"""

BANDS = """
bands(band, lower, upper, bounds) AS (VALUES
  ('[0,10)', 0.00, 10.00, '[)'), ('[10,50)', 10.00, 50.00, '[)'), ('[50,100]', 50.00, 100.00, '[]'),
  ('(100,)', 100.00, NULL, '()'), ('(,0)', NULL, 0.00, '()'))"""


def contains_sql(r: str, x: str) -> str:
    return (f"({r}.bounds IS NOT NULL AND ({r}.lower IS NULL OR CASE WHEN left({r}.bounds, 1) = '[' THEN {x} >= {r}.lower ELSE {x} > {r}.lower END)"
            f" AND ({r}.upper IS NULL OR CASE WHEN right({r}.bounds, 1) = ']' THEN {x} <= {r}.upper ELSE {x} < {r}.upper END))")


def domain_ranges_sql(low: str, high: str) -> str:
    """Ranges per part of one domain; the rules stand in sources.pgexport."""
    return f"""WITH rg AS (
  SELECT p_partkey, CASE WHEN p_partkey % 400 <> 2 THEN {low} END AS lower, CASE WHEN p_partkey % 400 <> 1 THEN {high} END AS upper,
    CASE p_partkey % 4 WHEN 0 THEN '[)' WHEN 1 THEN '(]' WHEN 2 THEN '()' ELSE '[]' END AS bounds
  FROM part
)"""


PRICE_LOW = "CAST((p_partkey * 37) % 49000 AS DECIMAL(18,2)) / 100"
DAY_LOW = "DATE '1995-01-01' + CAST((p_partkey * 13) % 2400 AS INTEGER)"
TIME_LOW = "TIMESTAMP '2024-01-01' + to_minutes(CAST((p_partkey * 1291) % 43200 AS BIGINT))"


def pg_sql() -> dict[str, str]:
    upd = ", ".join(f"({k}, {v})" for k, v in [(0, 1.5), (1, 2.25), (2, 3.0), (3, 4.75), (5, 5.5), (8, 6.25), (13, 7.0), (21, 8.75), (34, 9.5), (999999999, 10.0)])
    return {
        "filter_in_list": "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey IN (1, 3, 5)",
        "clean_column_names": WITH_FEED + """
SELECT o_orderkey AS f1st, total_price, store_name AS f_x, customer_name AS a_b, payment_type AS ok_1 FROM raw_sales""",
        "update_from_rows": f"""
SELECT p.p_partkey, p.p_name, coalesce(u.new_price, p.p_retailprice) AS p_retailprice
FROM part p LEFT JOIN (SELECT CAST(k AS BIGINT) AS k, CAST(v AS DOUBLE) AS new_price FROM (VALUES {upd}) t(k, v)) u ON u.k = p.p_partkey""",
        "insert_rows": "SELECT p_partkey, p_name, p_retailprice FROM part",
        "update_files": """
SELECT p.p_partkey, CASE WHEN u.k IS NULL THEN p.p_name ELSE u.new_name END AS p_name,
  CASE WHEN u.k IS NULL THEN p.p_retailprice ELSE u.new_price END AS p_retailprice
FROM part p LEFT JOIN (SELECT CAST(k AS BIGINT) AS k, new_name, CAST(new_price AS DOUBLE) AS new_price
  FROM (VALUES (0, 'first', 1.5), (1, NULL, 2.25), (8, 'third', NULL), (13, NULL, NULL)) t(k, new_name, new_price)) u ON u.k = p.p_partkey""",
        "range_parse": PART_RANGE + "\nSELECT p_partkey, lower, upper, bounds, true AS valid FROM rg",
        "range_bounds": PART_RANGE + """
SELECT p_partkey, bounds IS NULL AS isempty,
  bounds IS NOT NULL AND lower IS NULL AS lower_inf, bounds IS NOT NULL AND upper IS NULL AS upper_inf,
  bounds IS NOT NULL AND lower IS NOT NULL AND left(bounds, 1) = '[' AS lower_inc,
  bounds IS NOT NULL AND upper IS NOT NULL AND right(bounds, 1) = ']' AS upper_inc
FROM rg""",
        "range_contains": PART_RANGE + f"""
SELECT l.l_orderkey, l.l_linenumber, {contains_sql('rg', 'l.l_quantity')} AS in_range
FROM lineitem l JOIN rg ON rg.p_partkey = l.l_partkey""",
        "range_order": PART_RANGE + """
SELECT p_partkey,
  CAST(row_number() OVER (ORDER BY lower NULLS FIRST, upper NULLS FIRST, bounds NULLS FIRST, p_partkey) AS BIGINT) AS pos,
  count(*) OVER (PARTITION BY lower, upper, bounds) AS n_equal
FROM rg""",
        "range_format": PART_RANGE + """
SELECT p_partkey, CASE WHEN bounds IS NULL THEN 'empty'
  ELSE left(bounds, 1) || coalesce(CAST(lower AS VARCHAR), '') || ',' || coalesce(CAST(upper AS VARCHAR), '') || right(bounds, 1) END AS range_text
FROM rg""",
        "json_decode": "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
        "json_encode": "SELECT event_id, CAST(json_object('event_id', event_id, 'event_type', event_type, 'user_id', user_id) AS VARCHAR) AS json_text FROM events",
        "json_array_explode": """
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1 AS INTEGER) AS pos, l_partkey FROM lineitem""",
        "hstore_decode": """
SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'type', CASE WHEN p_partkey % 7 = 0 THEN 'DUP' ELSE p_type END FROM part
UNION ALL SELECT p_partkey, 'size', CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END FROM part
UNION ALL SELECT p_partkey, 'label', p_name || ' "' || p_brand || '"' FROM part""",
        "hstore_encode": """
SELECT p_partkey, '"brand"=>"' || p_brand || '", "type"=>"' || p_type || '", "size"=>'
  || CASE WHEN p_size % 5 = 0 THEN 'NULL' ELSE '"' || CAST(p_size AS VARCHAR) || '"' END AS hstore_text
FROM part""",
        "composite_decode": """
SELECT p_partkey, p_name AS name, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS size,
  CAST(p_retailprice AS DECIMAL(10,2)) AS price, true AS valid FROM part""",
        "offset_to_utc": """
SELECT event_id, ts - to_minutes(CAST(off AS BIGINT)) AS utc_ts,
  CASE WHEN off < 0 THEN '-' ELSE '+' END || lpad(CAST(abs(off) // 60 AS VARCHAR), 2, '0')
  || CASE WHEN abs(off) % 60 <> 0 THEN ':' || lpad(CAST(abs(off) % 60 AS VARCHAR), 2, '0') ELSE '' END AS offset_label
FROM (SELECT event_id, ts, CAST((user_id % 27 - 12) * 30 AS INTEGER) AS off FROM events)""",
        "range_malformed": """
SELECT p_partkey, CASE WHEN ok THEN CAST(p_size AS BIGINT) END AS lower, CASE WHEN ok THEN CAST(p_size + 1 + p_partkey % 7 AS BIGINT) END AS upper,
  CASE WHEN ok THEN CASE p_partkey % 8 WHEN 6 THEN '[]' ELSE '[)' END END AS bounds, ok AS valid
FROM (SELECT p_partkey, p_size, p_partkey % 8 IN (0, 6, 7) AS ok FROM part)""",
        "composite_malformed": """
SELECT p_partkey, CASE kind WHEN 0 THEN p_name WHEN 3 THEN p_name || '" q' WHEN 5 THEN p_name || ',b' END AS name,
  CASE WHEN kind IN (0, 3) THEN p_size END AS size, CASE WHEN kind IN (0, 3, 5) THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS price,
  kind IN (0, 3, 5) AS valid
FROM (SELECT *, p_partkey % 6 AS kind FROM part)""",
        "hstore_malformed": r"""
SELECT p_partkey, true AS valid, 'a b' AS key, CAST(p_partkey AS VARCHAR) || '"y\z' AS value FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey, true, 'c', NULL FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey, true, 'a', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 5 = 3
UNION ALL SELECT p_partkey, p_partkey % 5 = 4, NULL, NULL FROM part WHERE p_partkey % 5 IN (1, 2, 4)""",
        "offset_seconds": """
SELECT event_id, ts - to_seconds(CAST(s AS DOUBLE)) AS utc_ts,
  CASE WHEN s < 0 THEN '-' ELSE '+' END || lpad(CAST(abs(s) // 3600 AS VARCHAR), 2, '0')
  || CASE WHEN abs(s) % 3600 <> 0 THEN ':' || lpad(CAST(abs(s) // 60 % 60 AS VARCHAR), 2, '0') ELSE '' END
  || CASE WHEN abs(s) % 60 <> 0 THEN ':' || lpad(CAST(abs(s) % 60 AS VARCHAR), 2, '0') ELSE '' END AS offset_label
FROM (SELECT event_id, ts, CAST((user_id % 27 - 12) * 1800 + (event_id % 3) * 17 AS BIGINT) AS s FROM events)""",
        "range_join": "WITH " + BANDS.strip() + f"""
SELECT e.event_id, e.value, b.band FROM events e JOIN bands b ON {contains_sql('b', 'e.value')}""",
        "range_join_many": domain_ranges_sql(
            f"CAST({PRICE_LOW} AS DOUBLE)",
            "round(((p_partkey * 37) % 49000 + 25 * (1 + p_size % 3)) / 100.0 + CASE WHEN p_partkey = 3 THEN 10000000 ELSE 0 END, 2)",
        ) + f"""
SELECT e.event_id, e.value, rg.p_partkey FROM events e JOIN rg ON {contains_sql('rg', 'e.value')}""",
        "range_join_days": domain_ranges_sql(DAY_LOW, DAY_LOW + " + CAST(1 + p_size % 5 AS INTEGER)") + f"""
SELECT o.o_orderkey, CAST(o.order_day AS VARCHAR) AS order_day, rg.p_partkey
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders) o JOIN rg ON {contains_sql('rg', 'o.order_day')}""",
        "range_join_times": domain_ranges_sql(TIME_LOW, TIME_LOW + " + to_minutes(CAST(15 * (1 + p_size % 4) AS BIGINT))") + f"""
SELECT e.event_id, e.ts, rg.p_partkey FROM events e JOIN rg ON {contains_sql('rg', 'e.ts')}""",
    }


def all_sql() -> dict[str, str]:
    return {
        "parse_items": q_parse_items(),
        "explode_baskets": q_explode_baskets(),
        "stage_transactions": q_stage_transactions(),
        **load_sql(),
        **csv_sql(),
        **flat_sql(),
        **pg_sql(),
    }
