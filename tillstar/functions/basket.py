"""Column expressions of the warehouse load: pseudonymisation, parsing, baskets.

Everything here is a native Catalyst expression (whole-stage codegen, no
Python worker).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.schemas import PRICE

# Fixed values of the feed format.
TIMESTAMP_FORMAT = "dd-MM-yyyy HH:mm:ss"
BASKET_SEP = ", "
ITEM_SEP = " - "


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonym(name, salt: str | None = None) -> Column:
    """Lower-hex MD5 of the customer name (optionally salted SHA-256)."""
    c = col(name)
    if salt is None:
        return F.md5(c)
    return F.sha2(F.concat(F.lit(salt), c), 256)


def parse_timestamp(text) -> Column:
    """Dd-MM-yyyy HH:mm:ss -> TIMESTAMP_NTZ; impossible dates give NULL."""
    return F.try_to_timestamp(col(text), F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")


def parse_price(text) -> Column:
    """Text -> DECIMAL(10,2) (half-up rounding); bad text gives NULL."""
    return col(text).try_cast(PRICE)


def basket_items(products) -> Column:
    """Split a packed basket into its item texts."""
    return F.split(col(products), BASKET_SEP, -1)


def item_part(item, place: int) -> Column:
    """One ' - ' part of an item from 1, or from the end for -1; '' where there is none (no pattern is compiled per item)."""
    return F.split_part(col(item), F.lit(ITEM_SEP), F.lit(place))


def item_parts(item) -> Column:
    return F.split(col(item), ITEM_SEP, -1)


def _more_than_two_parts(item) -> Column:
    return F.length(col(item)) - F.length(F.replace(col(item), F.lit(ITEM_SEP), F.lit(""))) >= 2 * len(ITEM_SEP)


def item_struct(item) -> Column:
    """Item text -> struct(product_name, flavour_name, price_text, price).

    First part = name, last part = price, second part = flavour when there are
    more than two parts (parts beyond the second are dropped); no flavour is
    the empty-string member.
    """
    price_text = item_part(item, -1)
    return F.struct(
        item_part(item, 1).alias("product_name"),
        F.when(_more_than_two_parts(item), item_part(item, 2)).otherwise(F.lit("")).alias("flavour_name"),
        price_text.alias("price_text"),
        parse_price(price_text).alias("price"),
    )


def octet_length_over(c, limit: int) -> Column:
    """P5: VARCHAR(n) limits count bytes, not characters."""
    return F.octet_length(col(c)) > F.lit(limit)
