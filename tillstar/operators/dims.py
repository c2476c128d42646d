"""Dimension maintenance and key look-ups.

* New members: ``left_anti`` against the dimension (the reference's
  correlated ``NOT EXISTS``); NULL keys never match, as in SQL.
* Ids: ordered by natural key, continuing after the largest existing id.
* Look-ups: equi-joins.  A frame is broadcast only where its exact row count
  and the declared width of its texts prove it small in bytes; otherwise the
  join is left to Spark's statistics and AQE (which splits skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.keys import BROADCAST_MAX_BYTES, ROW_BYTES, ordered_ids_ranged

# Declared width of the names and digests of the dimensions (longer rows are quarantined).
TEXT_BYTES = 255


def fits_broadcast(df: DataFrame, rows: int | None, max_bytes: int | None = None) -> bool:
    """Whether ``rows`` rows of ``df`` are proven to fit the broadcast limit; texts count with their declared width."""
    if rows is None:
        return False
    texts = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    limit = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return rows * (ROW_BYTES + TEXT_BYTES * texts) <= limit


def small(df: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Broadcast hint where the exact row count (e.g. of dense ids 1..n) proves it small; else unchanged."""
    return F.broadcast(df) if fits_broadcast(df, known_rows) else df


def max_id(df: DataFrame, id_col: str) -> int:
    v = df.agg(F.max(id_col)).first()[0]
    return int(v) if v is not None else 0


def members_of(dim: DataFrame, candidates: DataFrame, keys: Sequence[str], cand_rows: int | None = None) -> DataFrame:
    """Dimension rows whose key is among the candidates.

    With a proven-small candidate set the candidates are broadcast and the
    dimension is streamed once without being shuffled (a large dimension is
    never moved for a small batch); otherwise a regular semi join.
    """
    c = candidates.select(*keys)
    if cand_rows is not None:
        c = small(c, known_rows=cand_rows)
    return dim.join(c, list(keys), "left_semi")


def new_members(
    candidates: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    cand_rows: int | None = None,
    existing_rows: int | None = None,
) -> DataFrame:
    """Candidates whose key is not in the dimension yet (NOT EXISTS).

    * ``existing_rows`` (exact dimension size, e.g. its dense-id maximum) small:
      the dimension's keys are broadcast into the anti join.
    * else ``cand_rows`` (exact candidate count) small: probe-then-anti, the
      existing members among the candidates are found by streaming the
      dimension against the broadcast candidates, then the anti join runs
      between two frames no larger than the candidates.
    * else a shuffle anti join.
    """
    known = existing.select(*keys)
    if fits_broadcast(known, existing_rows):
        return candidates.join(F.broadcast(known), list(keys), "left_anti")
    if fits_broadcast(known, cand_rows):
        hits = members_of(existing, candidates, keys, cand_rows).select(*keys)
        return candidates.join(small(hits, cand_rows), list(keys), "left_anti")
    return candidates.join(known, list(keys), "left_anti")


# ---- the four dimensions -------------------------------------------------

def distinct_stores(valid: DataFrame) -> DataFrame:
    return valid.select("store_name").distinct()


def distinct_customers(valid: DataFrame) -> DataFrame:
    return valid.select("customer_name", "store_name").distinct()


def distinct_products(items: DataFrame) -> DataFrame:
    return items.select("product_name", "price").distinct()


def distinct_flavours(items: DataFrame) -> DataFrame:
    return items.select("flavour_name").distinct()


def _start(df: DataFrame, id_col: str, start: int | None) -> int:
    return max_id(df, id_col) if start is None else start


def new_stores(
    valid: DataFrame, stores: DataFrame, path: str, start: int | None = None, bound: int | None = None
) -> DataFrame:
    """Stores of the batch not yet in ``stores``, with ids after ``start``.

    ``path``: where the sorted members are written; ``bound``: proven upper
    bound on the batch's distinct stores."""
    start = _start(stores, "store_id", start)
    new = new_members(distinct_stores(valid), stores, ["store_name"], bound, existing_rows=start)
    ids = ordered_ids_ranged(new, ["store_name"], "store_id", path, start)
    return ids.select("store_id", "store_name")


CUSTOMER_KEY = ["customer_name", "store_id"]


def customer_candidates(valid: DataFrame, stores_all: DataFrame, stores_rows: int | None = None) -> DataFrame:
    """Distinct (digest, store id) pairs of a batch."""
    cand = distinct_customers(valid).join(small(stores_all.select("store_id", "store_name"), known_rows=stores_rows), "store_name")
    return cand.select(*CUSTOMER_KEY)


def new_customers(
    valid: DataFrame,
    stores_all: DataFrame,
    customers: DataFrame,
    path: str,
    start: int | None = None,
    stores_rows: int | None = None,
    cand: DataFrame | None = None,
    cand_rows: int | None = None,
) -> DataFrame:
    """(digest, store) pairs not yet in ``customers``, with ids in (digest, store id) order."""
    if cand is None:
        cand = customer_candidates(valid, stores_all, stores_rows)
    new = new_members(cand, customers, CUSTOMER_KEY, cand_rows)
    ids = ordered_ids_ranged(new, CUSTOMER_KEY, "customer_id", path, _start(customers, "customer_id", start))
    return ids.select("customer_id", "customer_name", "store_id")


def new_products(
    items: DataFrame, products: DataFrame, path: str, start: int | None = None, bound: int | None = None
) -> DataFrame:
    """J4 + H2: one row per new product name, lowest price of the batch."""
    cand = items.groupBy("product_name").agg(F.min("price").alias("price"))
    start = _start(products, "product_id", start)
    new = new_members(cand, products, ["product_name"], bound, existing_rows=start)
    ids = ordered_ids_ranged(new, ["product_name"], "product_id", path, start)
    return ids.select("product_id", "product_name", "price")


def new_flavours(
    items: DataFrame, flavours: DataFrame, path: str, start: int | None = None, bound: int | None = None
) -> DataFrame:
    """Flavour names not yet in ``flavours`` ('' = no flavour)."""
    start = _start(flavours, "flavour_id", start)
    new = new_members(distinct_flavours(items), flavours, ["flavour_name"], bound, existing_rows=start)
    ids = ordered_ids_ranged(new, ["flavour_name"], "flavour_id", path, start)
    return ids.select("flavour_id", "flavour_name")


# ---- look-ups --------------------------------------------------------------

def lookup_store(df: DataFrame, stores: DataFrame, rows: int | None = None) -> DataFrame:
    """Store id by store name (left join: unmatched keep NULL)."""
    return df.join(small(stores.select("store_name", "store_id"), known_rows=rows), "store_name", "left")


def lookup_customer(df: DataFrame, customers: DataFrame, rows: int | None = None) -> DataFrame:
    """Customer id by (digest, store id), the declared unique key.

    Broadcast only when the exact customer count is known and small; the
    default is a shuffle join (customers grow with the data), where AQE may
    still split a hot customer's partition.
    """
    c = customers.select("customer_name", "store_id", "customer_id")
    if rows is not None:
        c = small(c, known_rows=rows)
    return df.join(c, ["customer_name", "store_id"], "left")


def lookup_customer_by_name(df: DataFrame, customers: DataFrame, rows: int | None = None) -> DataFrame:
    """J6b, reference mode: by digest only; the lowest matching id wins (H1)."""
    by_name = customers.groupBy("customer_name").agg(F.min("customer_id").alias("customer_id"))
    if rows is not None:
        by_name = small(by_name, known_rows=rows)
    return df.join(by_name, "customer_name", "left")


def lookup_product_flavour(
    items: DataFrame, products: DataFrame, flavours: DataFrame, product_rows: int | None = None, flavour_rows: int | None = None
) -> DataFrame:
    """Product id by name and flavour id by name."""
    out = items.join(small(products.select("product_name", "product_id"), known_rows=product_rows), "product_name", "left")
    return out.join(small(flavours.select("flavour_name", "flavour_id"), known_rows=flavour_rows), "flavour_name", "left")


def transaction_id_backfill(staged: DataFrame, transactions: DataFrame) -> DataFrame:
    """Read generated ids back by the 5-column natural key.

    Lowest id per key; a NULL in any key column never matches (plain
    equality, as in the reference's UPDATE ... FROM).
    """
    key = ["time_stamp", "store_id", "customer_id", "total_price", "payment_type"]
    ids = transactions.groupBy(*key).agg(F.min("transaction_id").alias("transaction_id"))
    return staged.join(ids, key, "left")
