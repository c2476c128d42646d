"""Staging of a raw feed (P1-P6, X1, X2) and the row verdict (Q4).

``stage(raw)`` is a pure projection: per-row native expressions, no shuffle.
The card number is dropped in this first projection and never cached or
written; the customer name leaves it only as its digest.  Of a rejected row,
whose fields may be shifted so that any of them holds a name or a card number,
this projection keeps no text and no digest of a single field at all, but a
total or time that parsed and a known payment type in a row of full width.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import basket as B
from tillstar.schemas import CORRUPT_COL, RAW_COLUMNS, RAW_LIMITS

# Quarantine reasons in the order they are tested; the first hit wins.
REASONS = ["corrupt_row", "bad_timestamp", "bad_total", "bad_price", "too_long"]


# Key of line digests where the caller gives none (a warehouse keeps its own, so that
# digests are the same in every run): a line may hold a card number, and an
# unkeyed digest of it could be searched for.
_PROCESS_KEY = secrets.token_hex(16)


def _raw_line_digest(raw: DataFrame, key: str):
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS])
    if CORRUPT_COL in raw.columns:
        line = F.coalesce(F.col(CORRUPT_COL), line)
    return F.md5(F.concat(F.lit(key + "|"), line))


PARTS = "_parts"


def with_parts(raw: DataFrame) -> DataFrame:
    """Split every basket into items and every item into its ' - ' parts once.

    The parts are a column of their own, so the checks below reuse one split
    instead of re-splitting per check (Catalyst does not inline a non-cheap
    expression that is referenced more than once).
    """
    products = F.coalesce(F.col("products"), F.lit(""))
    return raw.withColumn(PARTS, F.transform(B.basket_items(products), B.item_parts))


def verdict(raw: DataFrame):
    """Reason a raw row is rejected, or NULL for a good row (needs ``with_parts``)."""
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS}
    parts = F.col(PARTS)
    corrupt = F.col(CORRUPT_COL).isNotNull() if CORRUPT_COL in raw.columns else F.lit(False)
    too_long = F.lit(False)
    for c, n in RAW_LIMITS.items():
        too_long = too_long | B.octet_length_over(text[c], n)
    items_too_long = F.exists(
        parts,
        lambda a: (F.octet_length(a.getItem(0)) > 255) | (F.octet_length(F.coalesce(a.getItem(1), F.lit(""))) > 255),
    )
    bad_price = F.exists(parts, lambda a: B.parse_price(F.element_at(a, -1)).isNull())
    return (
        F.when(corrupt, F.lit("corrupt_row"))
        .when(B.parse_timestamp(text["time_stamp"]).isNull(), F.lit("bad_timestamp"))
        .when(B.parse_price(text["total_price"]).isNull(), F.lit("bad_total"))
        .when(bad_price, F.lit("bad_price"))
        .when(too_long | items_too_long, F.lit("too_long"))
    )


# Payment types whose text may be kept of a rejected row (fixed values of the feed).
KNOWN_PAYMENTS = ["CARD", "CASH"]


def stage(raw: DataFrame, salt: str | None = None, keep=(), line_key: str | None = None) -> DataFrame:
    """Raw text rows -> typed staging rows with a verdict column ``reason``.

    Empty CSV fields load as '' (not NULL) in the warehouse, so raw text is
    coalesced to '' before hashing or parsing.  ``keep`` names extra columns
    of ``raw`` carried through (e.g. a row-order column).  ``line_key`` is the
    key of the digests of rejected lines.
    """
    raw = with_parts(raw)
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS}
    file_path = F.col("_metadata.file_path") if "_metadata" in raw.columns else F.lit(None).cast("string")
    if "file_path" in raw.columns:
        file_path = F.col("file_path")
    typed = raw.select(
        *[F.col(k) for k in keep],
        verdict(raw).alias("reason"),
        B.parse_timestamp(text["time_stamp"]).alias("time_stamp"),
        text["store_name"].alias("store_name"),
        B.pseudonym(text["customer_name"], salt).alias("customer_name"),
        text["products"].alias("products"),
        B.parse_price(text["total_price"]).alias("total_price"),
        text["payment_type"].alias("payment_type"),
        _raw_line_digest(raw, line_key or salt or _PROCESS_KEY).alias("line_md5"),
        file_path.alias("file_path"),
    )
    good = F.col("reason").isNull()
    full = good | (F.col("reason") != "corrupt_row")
    return typed.withColumns({
        "time_stamp": F.when(full, F.col("time_stamp")),
        "store_name": F.when(good, F.col("store_name")),
        "customer_name": F.when(good, F.col("customer_name")),
        "products": F.when(good, F.col("products")),
        "total_price": F.when(full, F.col("total_price")),
        "payment_type": F.when(good | (full & F.upper("payment_type").isin(KNOWN_PAYMENTS)), F.col("payment_type")),
        "line_md5": F.when(~good, F.col("line_md5")),
    })


TRANSACTION_COLUMNS = ["time_stamp", "store_name", "customer_name", "products", "total_price", "payment_type"]


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("reason").isNull())


def quarantined(staged: DataFrame) -> DataFrame:
    """Rejected rows as ``stage`` leaves them: reason, keyed line digest, file, and what is proven harmless."""
    return staged.where(F.col("reason").isNotNull()).select(
        "reason",
        "line_md5",
        "file_path",
        F.col("time_stamp").cast("string").alias("time_stamp"),
        "store_name",
        F.col("total_price").cast("string").alias("total_price"),
        "payment_type",
    )


def explode_baskets(df: DataFrame, keep=("transaction_id",)) -> DataFrame:
    """One row per basket item, with its 0-based position."""
    return df.select(*keep, F.posexplode(B.basket_items("products")).alias("item_pos", "item"))


def parse_items(df: DataFrame, keep=("transaction_id",)) -> DataFrame:
    """X1 + X2: one typed row per basket item."""
    e = explode_baskets(df, keep)
    s = B.item_struct("item")
    return e.select(
        *keep,
        "item_pos",
        s["product_name"].alias("product_name"),
        s["flavour_name"].alias("flavour_name"),
        s["price"].alias("price"),
    )
