"""Text columns as a Postgres export would print them, derived from the test tables.

The rules below are fixed values shared with the oracle, which computes the
expected decoded values from the same source columns (not by re-parsing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.schemas import PRICE

# Range kind of a part = p_partkey mod 6 (fixed):
#   0 '[lo,hi)'   1 '(lo,hi]'   2 '[lo,)'   3 '(,hi)'   4 'empty'   5 '["lo","hi"]'
# with lo = p_size and hi = p_size + 1 + p_partkey mod 7.
RANGE_KINDS = 6


def range_bounds_of(df: DataFrame) -> tuple[Column, Column, Column]:
    kind = F.col("p_partkey") % RANGE_KINDS
    lo = F.col("p_size").cast("bigint")
    hi = (F.col("p_size") + 1 + F.col("p_partkey") % 7).cast("bigint")
    return kind, lo, hi


def part_ranges(part: DataFrame) -> DataFrame:
    kind, lo, hi = range_bounds_of(part)
    s_lo, s_hi = lo.cast("string"), hi.cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit("["), s_lo, F.lit(","), s_hi, F.lit(")")))
        .when(kind == 1, F.concat(F.lit("("), s_lo, F.lit(","), s_hi, F.lit("]")))
        .when(kind == 2, F.concat(F.lit("["), s_lo, F.lit(",)")))
        .when(kind == 3, F.concat(F.lit("(,"), s_hi, F.lit(")")))
        .when(kind == 4, F.lit("empty"))
        .otherwise(F.concat(F.lit('["'), s_lo, F.lit('","'), s_hi, F.lit('"]')))
    )
    return part.select("p_partkey", "p_size", kind.alias("kind"), lo.alias("lo"), hi.alias("hi"), text.alias("range_text"))


def part_range_struct(part: DataFrame) -> DataFrame:
    """The same ranges built directly as structs (for the formatter)."""
    from tillstar.functions.pgtypes import make_range

    kind, lo, hi = range_bounds_of(part)
    bounds = (
        F.when(kind.isin(0, 2), F.lit("[)"))
        .when(kind == 1, F.lit("(]"))
        .when(kind == 3, F.lit("()"))
        .when(kind == 5, F.lit("[]"))
    )
    lower = F.when(kind.isin(0, 1, 2, 5), lo)
    upper = F.when(kind.isin(0, 1, 3, 5), hi)
    return part.select("p_partkey", make_range(lower, upper, bounds).alias("range"))


# Price bands for the range join (fixed literal rows, the small side).
PRICE_BANDS = ["[0,10)", "[10,50)", "[50,100]", "(100,)", "(,0)", "empty", "10,50"]


# Ranges over a domain, one per part (fixed rules): key k and size z of a part.
#   price: low end ((37 k) mod 49000) / 100, width 0.25 (1 + z mod 3)
#   day:   low end 1995-01-01 + (13 k) mod 2400 days, width 1 + z mod 5 days
#   time:  low end 2024-01-01 00:00 + (1291 k) mod 43200 minutes, width 15 (1 + z mod 4) minutes
# Open above where k mod 400 = 1, open below where k mod 400 = 2; of k = 3 the upper price is
# 10,000,000 higher.  Bounds are '[)', '(]', '()', '[]' for k mod 4 = 0, 1, 2, 3.
DOMAIN_BOUNDS = ["[)", "(]", "()", "[]"]


def domain_ranges(part: DataFrame, domain: str) -> DataFrame:
    """(p_partkey, range_text) of one ``domain``: price, day or time."""
    k, z = F.col("p_partkey"), F.col("p_size")
    if domain == "price":
        low = ((k * 37) % 49000 / 100).cast("decimal(10,2)")
        high = low + ((z % 3 + 1) * 25 / F.lit(100)).cast("decimal(10,2)") + F.when(k == 3, 10_000_000).otherwise(0)
        high = high.cast("decimal(10,2)")
    elif domain == "day":
        low = F.date_add(F.lit("1995-01-01").cast("date"), ((k * 13) % 2400).cast("int"))
        high = F.date_add(low, z % 5 + 1)
    elif domain == "time":
        minutes = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))
        low = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes((k * 1291) % 43200)
        high = low + minutes((z % 4 + 1) * 15)
    else:
        raise ValueError(domain)
    end = lambda x, open_: F.when(k % 400 == open_, F.lit("")).otherwise(F.concat(F.lit('"'), x.cast("string"), F.lit('"')))
    bounds = F.get(F.array(*[F.lit(b) for b in DOMAIN_BOUNDS]), (k % 4).cast("int"))
    text = F.concat(F.substring(bounds, 1, 1), end(low, 2), F.lit(","), end(high, 1), F.substring(bounds, 2, 1))
    return part.select("p_partkey", text.alias("range_text"))


def hstore_text(part: DataFrame) -> DataFrame:
    """'"brand"=>..., "type"=>..., "size"=>NULL|"n", "label"=>"name \\"brand\\""'
    with size NULL when p_size mod 5 = 0, and a repeated key
    '"type"=>"DUP"' appended when p_partkey mod 7 = 0 (last one wins)."""
    size = F.when(F.col("p_size") % 5 == 0, F.lit("NULL")).otherwise(
        F.concat(F.lit('"'), F.col("p_size").cast("string"), F.lit('"'))
    )
    label = F.concat(F.lit('"'), F.col("p_name"), F.lit(' \\"'), F.col("p_brand"), F.lit('\\""'))
    dup = F.when(F.col("p_partkey") % 7 == 0, F.lit(', "type"=>"DUP"')).otherwise(F.lit(""))
    text = F.concat(
        F.lit('"brand"=>"'), F.col("p_brand"), F.lit('", "type"=>"'), F.col("p_type"), F.lit('", "size"=>'), size,
        F.lit(', "label"=>'), label, dup,
    )
    return part.select("p_partkey", text.alias("hstore"))


def composite_text(part: DataFrame) -> DataFrame:
    """'("name",size,price)' with size empty (NULL) when p_size mod 5 = 0."""
    size = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_size").cast("string"))
    name = F.concat(F.lit('"'), F.replace(F.col("p_name"), F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.concat(F.lit("("), name, F.lit(","), size, F.lit(","), F.col("p_retailprice").cast(PRICE).cast("string"), F.lit(")"))
    return part.select("p_partkey", text.alias("composite"))


def event_offsets(events: DataFrame) -> DataFrame:
    """Offset minutes east of UTC per event: (user_id mod 27 - 12) * 30."""
    return events.select("event_id", "ts", ((F.col("user_id") % 27 - 12) * 30).cast("int").alias("offset_minutes"))


def order_partkey_json(lineitem: DataFrame) -> DataFrame:
    """JSON array text of the sorted part keys of each order."""
    return lineitem.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list("l_partkey"))).alias("parts_json"))


# Well and badly written texts by a part's key (fixed rules; the oracle states what each one decodes to).

def odd_ranges(part: DataFrame) -> DataFrame:
    """Range texts of eight kinds: plain, cut off twice, reversed, three bounds, no number, spaced, escaped."""
    k, lo = F.col("p_partkey"), F.col("p_size").cast("string")
    hi = (F.col("p_size") + 1 + k % 7).cast("string")
    forms = ["[{},{})", "[{},{}", "{},{})", None, "[{},{},1)", "[x{},{})", " [ {} ,\t{} ] ", '[\\{},"{}")']
    text = F.concat(F.lit("["), hi, F.lit(","), lo, F.lit(")"))
    for i, form in enumerate(forms):
        if form:
            a, b, c = form.split("{}")
            text = F.when(k % 8 == i, F.concat(F.lit(a), lo, F.lit(b), hi, F.lit(c))).otherwise(text)
    return part.select("p_partkey", text.alias("range_text"))


def odd_composites(part: DataFrame) -> DataFrame:
    """Row values of six kinds: plain, a field short, no parentheses, a doubled quote, no number, an escaped comma."""
    kind = F.col("p_partkey") % 6
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast(PRICE).cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit('("'), name, F.lit('",'), size, F.lit(","), price, F.lit(")")))
        .when(kind == 1, F.concat(F.lit("("), name, F.lit(","), size, F.lit(")")))
        .when(kind == 2, F.concat_ws(",", name, size, price))
        .when(kind == 3, F.concat(F.lit('("'), name, F.lit('"" q",'), size, F.lit(","), price, F.lit(") ")))
        .when(kind == 4, F.concat(F.lit("("), name, F.lit(",x"), size, F.lit(","), price, F.lit(")")))
        .otherwise(F.concat(F.lit("("), name, F.lit("\\,b,,"), price, F.lit(")")))
    )
    return part.select("p_partkey", text.alias("composite"))


def odd_hstores(part: DataFrame) -> DataFrame:
    """hstore texts of five kinds: escapes and a bare NULL, no value, an empty pair, a key twice, nothing."""
    kind, k = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit('"a b"=>"'), k, F.lit('\\"y\\\\z", c=>NULL')))
        .when(kind == 1, F.concat(F.lit('"a"=>"'), k, F.lit('", b=>')))
        .when(kind == 2, F.concat(F.lit("a=>"), k, F.lit(",, c=>d")))
        .when(kind == 3, F.concat(F.lit(" a => 1 ,a =>\""), k, F.lit('" ')))
        .otherwise(F.lit(""))
    )
    return part.select("p_partkey", text.alias("hstore"))


def event_offsets_with_seconds(events: DataFrame) -> DataFrame:
    """As ``event_offsets``, with (event_id mod 3) 17 seconds more."""
    seconds = ((F.col("event_id") % 3) * 17).cast("int").alias("offset_seconds")
    return events.select("event_id", "ts", ((F.col("user_id") % 27 - 12) * 30).cast("int").alias("offset_minutes"), seconds)
