"""Sales feed derived from the TPC-H-like test tables.

One raw sale per order that has at least one line item.  The rules are fixed
values shared with the DuckDB oracle (see ``tillstar.oracle``):

* time stamp: order date plus (order key mod 24) hours, printed dd-MM-yyyy HH:mm:ss
* store: name of nation (customer nation + order key mod 2) mod 25
* basket: items ordered by line number, part key, extended price, joined by ", ";
  item = part name, then " - " + part type unless part size mod 3 = 0,
  then " - " + retail price as DECIMAL(10,2)
* payment: CARD for even order keys, else CASH; card number = customer key
  left-padded with "4" to 16 characters (CARD only)

All joins are equi-joins on the table keys; the per-order aggregation is a
regular hash aggregate on ``l_orderkey`` whose group size is the number of
lines of one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.schemas import PRICE, RAW_COLUMNS

# Two-feed split (fixed value): feed 1 holds the orders below this key.
FEED1_MAX_ORDERKEY = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_text() -> Column:
    flavour = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" - "), F.col("p_type")))
    price = F.col("p_retailprice").cast(PRICE).cast("string")
    return F.concat(F.col("p_name"), flavour, F.lit(" - "), price)


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed as seven text columns plus ``o_orderkey`` (row order only)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # Parts and customers grow with the data, so neither is broadcast (a file's size says little of its rows in memory).
    items = lines.join(part.hint("merge"), lines.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", item_text().alias("item")
    )
    # Ordered string aggregate per order (its group is the lines of one order), after plain rows have come to their
    # order: before that it would sort every scan's rows for next to no reduction.
    baskets = items.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.expr("listagg(item, ', ') WITHIN GROUP (ORDER BY l_linenumber, l_partkey, l_extendedprice)").alias("products")
    )

    # The baskets come last, so their texts move no second time.
    o = orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey)
    o = o.join(nation, nation.n_nationkey == (o.c_nationkey + o.o_orderkey % 2) % 25)
    o = o.join(baskets, o.o_orderkey == baskets.l_orderkey)

    hours = (F.col("o_orderkey") % 24).cast("int")
    card = (F.col("o_orderkey") % 2) == 0
    return o.select(
        "o_orderkey",
        F.date_format(
            F.col("o_orderdate") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), hours, F.lit(0), F.lit(0)),
            "dd-MM-yyyy HH:mm:ss",
        ).alias("time_stamp"),
        F.col("n_name").alias("store_name"),
        F.col("c_name").alias("customer_name"),
        "products",
        F.col("o_totalprice").cast(PRICE).cast("string").alias("total_price"),
        F.when(card, F.lit("CARD")).otherwise(F.lit("CASH")).alias("payment_type"),
        F.when(card, F.lpad(F.col("o_custkey").cast("string"), 16, "4")).alias("card_number"),
    )


def feed_split(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feed 1 (order keys below the split) and feed 2 (the rest)."""
    k = F.col("o_orderkey")
    return feed.where(k < FEED1_MAX_ORDERKEY), feed.where(k >= FEED1_MAX_ORDERKEY)


def local_feed(feed: DataFrame) -> DataFrame:
    """The same sales under the header names of the local (flat) variant."""
    return feed.select(
        "o_orderkey",
        F.col("time_stamp").alias("timestamp"),
        F.col("store_name").alias("store"),
        "customer_name",
        F.col("products").alias("basket_items"),
        F.col("total_price").cast("double").alias("total_price"),
        F.col("payment_type").alias("cash_or_card"),
        "card_number",
    )


# Damage rules of the dirty feed (fixed values, shared with the oracle):
#   order key mod 101 = 7  -> impossible date 31-02 (bad_timestamp)
#   order key mod 103 = 11 -> total "xx" (bad_total)
#   order key mod 107 = 13 -> an extra item without price ", Water" (bad_price)
#   order key mod 109 = 17 -> line cut after the store name (corrupt_row)
#   order key mod 113 = 19 -> store name longer than 255 bytes (too_long)
def dirty_feed(feed: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    ts = F.when(k % 101 == 7, F.concat(F.lit("31-02"), F.substring("time_stamp", 6, 100))).otherwise(F.col("time_stamp"))
    total = F.when(k % 103 == 11, F.lit("xx")).otherwise(F.col("total_price"))
    products = F.when(k % 107 == 13, F.concat(F.col("products"), F.lit(", Water"))).otherwise(F.col("products"))
    store = F.when(k % 113 == 19, F.concat(F.col("store_name"), F.lit("#" * 250))).otherwise(F.col("store_name"))
    return feed.select(
        "o_orderkey",
        ts.alias("time_stamp"),
        store.alias("store_name"),
        "customer_name",
        products.alias("products"),
        total.alias("total_price"),
        "payment_type",
        "card_number",
        (k % 109 == 17).alias("_cut"),
    )


def csv_field(c: Column) -> Column:
    """Quote one CSV field the way a CSV writer does (always quoted)."""
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_lines(feed: DataFrame) -> DataFrame:
    """Raw feed rendered as headerless CSV text lines (one column ``value``).

    NULL fields become empty fields; rows flagged ``_cut`` keep only their
    first two fields, which makes them corrupt (wrong column count).
    """
    fields = [F.coalesce(csv_field(F.col(c)), F.lit("")) for c in RAW_COLUMNS]
    full = F.concat_ws(",", *fields)
    cut = F.concat_ws(",", *fields[:2])
    cols = feed.columns
    line = F.when(F.col("_cut"), cut).otherwise(full) if "_cut" in cols else full
    return feed.select("o_orderkey", line.alias("value"))


# Fields missing from lines of the shifted feed: order key mod 97 -> place of the field (fixed values).
MISSING_FIELDS = {3: 0, 5: 3, 7: 6}


def shifted_lines(feed: DataFrame) -> DataFrame:
    """The dirty feed as CSV lines, some of them without their first, middle or last field."""
    fields = [F.coalesce(csv_field(F.col(c)), F.lit("")) for c in RAW_COLUMNS]
    dirty = feed.select("*", (F.col("o_orderkey") % 97).alias("_rest"))
    full = F.when(F.col("_cut"), F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
    for rest, place in MISSING_FIELDS.items():
        full = F.when(F.col("_rest") == rest, F.concat_ws(",", *fields[:place], *fields[place + 1 :])).otherwise(full)
    return dirty.select("o_orderkey", full.alias("value"))
