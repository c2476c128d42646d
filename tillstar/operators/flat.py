"""The local (flat) variant of the load.

A header feed is exploded into one row per basket item with dense 0-based
group numbers for time stamp, store, customer, item and flavour, then split
into six relational tables.  The parsing rules differ from the warehouse
load on purpose (they are the local variant's own):

* items split on a bare ',' and left-trimmed; parts split on a bare '-' and
  **not** trimmed ('Latte ', ' 2.45');
* price = last part; the rest is padded to two parts with ' '; item = first
  part, flavour = **last** part of the rest (a one-part item gives ' ', ' ').

Group numbers are ranks of distinct keys (text order for the time stamp),
computed with the distributed ordered-id helpers and joined back.  Table rows
take the values of each key's first row in source order (row order column,
then item position), via partial aggregates (so a hot key is
combined map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.basket import parse_timestamp
from tillstar.operators.keys import GroupMaps, join_group_number, number_keys, ordered_ids_ranged, stacked_keys
from tillstar.session import file_state, list_dir, materialize, move, publish_file, remove_dir

FLAT_COLUMNS = [
    "transactions_id",
    "time_stamp",
    "store_id",
    "store",
    "customer_id",
    "customer_name",
    "total_price",
    "payment_type",
    "item_id",
    "item",
    "flavour_id",
    "flavour",
    "price",
]

PAD = " "


def explode_items(local: DataFrame, order_col: str = "o_orderkey", keep: Sequence[str] = ()) -> DataFrame:
    """One row per item with untrimmed item / flavour / price text; ``keep``: further columns of the sale."""
    e = local.select(
        *keep,
        order_col,
        F.col("timestamp").alias("time_stamp"),
        "store",
        "customer_name",
        "total_price",
        F.col("cash_or_card").alias("payment_type"),
        F.posexplode(F.split(F.col("basket_items"), ",", -1)).alias("item_pos", "product"),
    )
    a = F.split(F.ltrim(F.col("product")), "-", -1)
    head = F.slice(a, 1, F.size(a) - 1)
    padded = F.when(F.size(head) < 2, F.concat(head, F.array(F.lit(PAD)))).otherwise(head)
    return e.select(
        *keep,
        order_col,
        "item_pos",
        "time_stamp",
        "store",
        "customer_name",
        "total_price",
        "payment_type",
        padded.getItem(0).alias("item"),
        F.element_at(padded, -1).alias("flavour"),
        F.element_at(a, -1).alias("price"),
    )


# Kind of group number (the key's column) -> its number's column.
GROUPS = {
    "time_stamp": "transactions_id",
    "store": "store_id",
    "customer_name": "customer_id",
    "item": "item_id",
    "flavour": "flavour_id",
}


# The kinds whose key a sale has (column of the local feed -> kind); the other two are of its items.
SALE_KEYS = {"timestamp": "time_stamp", "store": "store", "customer_name": "customer_name"}


def numbered_sales(local: DataFrame, scratch: str, order_col: str = "o_orderkey") -> tuple[DataFrame, GroupMaps]:
    """The sales with items, written once to ``scratch``, and the group numbers of the five keys (one pass)."""
    cols = [order_col, "timestamp", "store", "customer_name", "total_price", "cash_or_card", "basket_items"]
    sales = materialize(local.where(F.col("basket_items").isNotNull()).select(*cols), f"{scratch}/sales")
    of_sales = stacked_keys(sales, {kind: col for col, kind in SALE_KEYS.items()})
    of_items = stacked_keys(explode_items(sales, order_col), {k: k for k in GROUPS if k not in SALE_KEYS.values()})
    return sales, number_keys(of_sales.unionByName(of_items), f"{scratch}/groups")


def flat_frame(local: DataFrame, scratch: str, order_col: str = "o_orderkey", keep_order: bool = False) -> DataFrame:
    """The 13-column flat frame (plus the order columns when asked).

    Time stamps, stores and customers are numbered on the sales, before each becomes a row per item.
    """
    sales, maps = numbered_sales(local, scratch, order_col)
    for col, kind in SALE_KEYS.items():
        sales = join_group_number(sales, maps, kind, col, GROUPS[kind])
    df = explode_items(sales, order_col, keep=[GROUPS[kind] for kind in SALE_KEYS.values()])
    for kind in GROUPS:
        if kind not in SALE_KEYS.values():
            df = join_group_number(df, maps, kind, kind, GROUPS[kind])
    cols = FLAT_COLUMNS + ([order_col, "item_pos"] if keep_order else [])
    return df.select(*cols)


def _first_row(flat: DataFrame, key: str, values: list[str], order_col: str) -> DataFrame:
    """Values of each key's first row in source order.

    Rows with the same values are first reduced to the place of their first one: a number, as
    only fixed-width values are aggregated without sorting all rows.
    """
    if isinstance(flat.schema[order_col].dataType, T.IntegralType):
        first = F.lit(str(-(10**19))).cast("decimal(20,0)")  # NULL comes before all, as in a struct
        places = F.coalesce(F.col(order_col).cast("decimal(20,0)"), first)
        order = (places * F.lit(2**31).cast("decimal(10,0)") + F.col("item_pos").cast("decimal(10,0)")).alias("_order")
    else:
        order = F.struct(F.col(order_col), F.col("item_pos")).alias("_order")
    rows = flat.select(key, *values, order).groupBy(key, *values).agg(F.min("_order").alias("_order"))
    return rows.groupBy(key).agg(*[F.min_by(F.col(v), "_order").alias(v) for v in values])


def products_table(flat: DataFrame, order_col: str = "o_orderkey") -> DataFrame:
    """A5: one product per item, price of its first row as NUMERIC(10,2)."""
    t = _first_row(flat, "item_id", ["item", "price"], order_col)
    return t.select(
        F.col("item_id").alias("product_id"),
        F.col("item").alias("product_name"),
        F.trim(F.col("price")).try_cast("decimal(10,2)").alias("price"),
    )


def sales_table(flat: DataFrame, order_col: str = "o_orderkey") -> DataFrame:
    """A5: one sale per time-stamp group, values of its first row."""
    t = _first_row(flat, "transactions_id", ["time_stamp", "store_id", "customer_id", "total_price"], order_col)
    return t.select(
        "transactions_id",
        parse_timestamp("time_stamp").alias("time_stamp"),
        "store_id",
        "customer_id",
        "total_price",
    )


def orders_table(flat: DataFrame, scratch: str, order_col: str = "o_orderkey") -> DataFrame:
    """K2: one order line per flat row, SERIAL id in source order."""
    df = flat.select(order_col, "item_pos", F.col("item_id").alias("product_id"), "flavour_id", "transactions_id")
    ids = ordered_ids_ranged(df, [order_col, "item_pos"], "order_id", f"{scratch}/orders")
    return ids.select("order_id", "product_id", "flavour_id", "transactions_id")


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO NOTHING.

    Rows are reduced to one per key (lowest ``order_col``; the minimum of a
    struct is a partial aggregate), keys already in the target are dropped
    (left anti), and the rest is appended to the target.  A NULL in a key never
    conflicts, so such rows are all inserted.
    """
    cols = list(target.columns)
    others = [c for c in cols if c not in keys]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    row = F.struct(F.col(order_col).alias("_at"), *[F.col(c) for c in others])
    first = rows.where(whole).groupBy(*keys).agg(F.min(row).alias("_row"))
    first = first.select(*keys, *[F.col("_row")[c].alias(c) for c in others])
    new = first.join(target.select(*keys), keys, "left_anti").select(*cols)
    return target.unionByName(new).unionByName(rows.where(~whole).select(*cols))


class KeyConflictError(ValueError):
    pass


def insert_or_fail(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT without ON CONFLICT: any key already present, or repeated
    among the new rows, fails the insert (checked before anything is written)."""
    clash = rows.select(*keys).join(target.select(*keys), keys, "left_semi").limit(1).count()
    dup = rows.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if clash or dup:
        raise KeyConflictError(f"duplicate key on {keys}")
    return target.unionByName(rows.select(*target.columns))


def customers_table(flat: DataFrame, order_col: str = "o_orderkey") -> DataFrame:
    t = _first_row(flat, "customer_name", ["customer_id"], order_col)
    return t.select("customer_id", "customer_name")


def stores_table(flat: DataFrame, order_col: str = "o_orderkey") -> DataFrame:
    t = _first_row(flat, "store", ["store_id"], order_col)
    return t.select("store_id", F.col("store").alias("store_name"))


def flavours_table(flat: DataFrame, order_col: str = "o_orderkey") -> DataFrame:
    t = _first_row(flat, "flavour", ["flavour_id"], order_col)
    return t.select("flavour_id", "flavour")


def flat_tables(flat: DataFrame, scratch: str, order_col: str = "o_orderkey") -> dict[str, DataFrame]:
    """The six relational tables of the local variant."""
    return {
        "customers": customers_table(flat, order_col),
        "stores": stores_table(flat, order_col),
        "products": products_table(flat, order_col),
        "flavours": flavours_table(flat, order_col),
        "sales": sales_table(flat, order_col),
        "orders": orders_table(flat, scratch, order_col),
    }


FLAT_TABLES = ["customers", "stores", "products", "flavours", "sales", "orders"]
# Folder of tables that are written and not yet published, and the marker from which on they will be.
STAGED, PUBLISHED = "_staged", "_publish"


def write_flat_tables(flat: DataFrame, out_dir: str, scratch: str, order_col: str = "o_orderkey") -> None:
    """Write, audit, publish (instead of one INSERT per row).

    The frame is written once; the six tables are staged beside the published ones and the
    unique key of each is audited (W3) there, so a duplicate changes no table.  Then one
    marker file decides that they are published, table by table; a run that is lost
    in between is completed by ``finish_publication``, which the next write calls first.
    """
    spark, out = flat.sparkSession, out_dir.rstrip("/")
    finish_publication(spark, out)
    remove_dir(spark, f"{out}/{STAGED}")  # of a run lost before its marker
    flat = materialize(flat, f"{scratch}/flat")
    conflicts = []
    for name, df in flat_tables(flat, scratch, order_col).items():
        key = df.columns[0]
        staged = materialize(df, f"{out}/{STAGED}/{name}")
        if staged.groupBy(key).count().where(F.col("count") > 1).limit(1).count():
            conflicts.append(f"{name}: duplicate {key}")
    if conflicts:
        remove_dir(spark, f"{out}/{STAGED}")
        raise KeyConflictError("; ".join(conflicts))
    publish_file(spark, f"{out}/{PUBLISHED}", "\n".join(FLAT_TABLES))
    finish_publication(spark, out)


def finish_publication(spark: SparkSession, out_dir: str) -> bool:
    """Put staged tables in the published ones' place if their marker is there; may be called again at any point."""
    out = out_dir.rstrip("/")
    if file_state(spark, f"{out}/{PUBLISHED}") is None:
        return False
    for name in list_dir(spark, f"{out}/{STAGED}"):
        remove_dir(spark, f"{out}/{name}")
        move(spark, f"{out}/{STAGED}/{name}", f"{out}/{name}")
    remove_dir(spark, f"{out}/{STAGED}")
    remove_dir(spark, f"{out}/{PUBLISHED}")
    return True
