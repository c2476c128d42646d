"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the given test tables (through the derived sales feed or
directly) over whole tables; column names match ``tillstar.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import pgtypes as PG
from tillstar.operators import dims as D
from tillstar.operators import flat as FL
from tillstar.operators import quality as Q
from tillstar.operators import rows as R
from tillstar.operators.keys import ordered_ids_ranged
from tillstar.operators.range_join import range_join
from tillstar.plans import staging
from tillstar.plans.load import Warehouse, load_batch, star_view
from tillstar.schemas import STAR_TABLES
from tillstar.session import configure, materialize, remove_dir, work_dir
from tillstar.sources import csv as C
from tillstar.sources import pgexport as X
from tillstar.sources.feed import (
    FEED1_MAX_ORDERKEY, csv_lines, dirty_feed, feed_split, local_feed, sales_feed, shifted_lines, table,
)

Query = Callable[[SparkSession, str], DataFrame]


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return sales_feed(spark, sf_dir)


def q_stage_transactions(spark, sf_dir):
    st = staging.stage(_feed(spark, sf_dir))
    return staging.valid_rows(st).select(*staging.TRANSACTION_COLUMNS)


def q_explode_baskets(spark, sf_dir):
    st = staging.stage(_feed(spark, sf_dir), keep=["o_orderkey"])
    return staging.explode_baskets(st, keep=["o_orderkey"])


def q_parse_items(spark, sf_dir):
    st = staging.stage(_feed(spark, sf_dir), keep=["o_orderkey"])
    return staging.parse_items(st, keep=["o_orderkey"])


# ---- warehouse loads ------------------------------------------------------
# Loads are written under the shared checkpoint folder.  Within one Spark
# application a loaded warehouse is reused by the queries that only read it.
_LOADED: dict[tuple, Warehouse] = {}


def load_feed(spark: SparkSession, sf_dir: str, batches: str = "one", reuse: bool = True) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, batches)
    if reuse and key in _LOADED:
        return _LOADED[key]
    feed = _feed(spark, sf_dir)
    wh = Warehouse(spark, work_dir(spark, f"wh-{batches}")).bootstrap()
    if batches == "one":
        load_batch(wh, feed.drop("o_orderkey"), 1, source="feed", keep_scratch=True)
    else:
        f1, f2 = feed_split(feed)
        load_batch(wh, f1.drop("o_orderkey"), 1, source="feed1")
        load_batch(wh, f2.drop("o_orderkey"), 2, source="feed2")
    _LOADED[key] = wh
    return wh


def q_star_load(spark, sf_dir):
    return star_view(load_feed(spark, sf_dir, "one"))


def q_star_load_two_batches(spark, sf_dir):
    return star_view(load_feed(spark, sf_dir, "two"))


def q_fact_transactions(spark, sf_dir):
    return load_feed(spark, sf_dir, "one").read("transactions")


def q_basket_lines(spark, sf_dir):
    return load_feed(spark, sf_dir, "one").read("baskets")


def _dim(table):
    def q(spark, sf_dir):
        return load_feed(spark, sf_dir, "two").read(table)

    q.__name__ = f"q_dim_{table}_incremental"
    return q


def _valid(spark, sf_dir):
    return staging.valid_rows(staging.stage(_feed(spark, sf_dir)))


def q_distinct_stores(spark, sf_dir):
    return D.distinct_stores(_valid(spark, sf_dir))


def q_distinct_customers(spark, sf_dir):
    return D.distinct_customers(_valid(spark, sf_dir))


def q_distinct_products(spark, sf_dir):
    return D.distinct_products(staging.parse_items(_valid(spark, sf_dir), keep=[]))


def q_distinct_flavours(spark, sf_dir):
    return D.distinct_flavours(staging.parse_items(_valid(spark, sf_dir), keep=[]))


def _loaded_valid(spark, sf_dir):
    """The loaded warehouse and the valid staged rows of its batch (read from
    the load's own staged copy instead of deriving the feed again)."""
    wh = load_feed(spark, sf_dir, "one")
    return wh, staging.valid_rows(wh.staged(1))


def _with_store(spark, sf_dir):
    wh, valid = _loaded_valid(spark, sf_dir)
    return wh, D.lookup_store(valid, wh.read("stores"))


def q_lookup_store(spark, sf_dir):
    _, df = _with_store(spark, sf_dir)
    return df.select("time_stamp", "store_name", "store_id", "customer_name", "total_price", "payment_type")


def q_lookup_customer(spark, sf_dir):
    wh, df = _with_store(spark, sf_dir)
    df = D.lookup_customer(df, wh.read("customers"))
    return df.select("time_stamp", "store_id", "customer_name", "customer_id", "total_price", "payment_type")


def q_lookup_customer_by_name(spark, sf_dir):
    wh, df = _with_store(spark, sf_dir)
    df = D.lookup_customer_by_name(df, wh.read("customers"))
    return df.select("time_stamp", "store_id", "customer_name", "customer_id", "total_price", "payment_type")


def q_transaction_id_backfill(spark, sf_dir):
    wh, df = _with_store(spark, sf_dir)
    df = D.lookup_customer(df, wh.read("customers"))
    df = D.transaction_id_backfill(df, wh.read("transactions"))
    return df.select("time_stamp", "store_id", "customer_id", "total_price", "payment_type", "transaction_id")


# ---- CSV sources / sinks and audits -----------------------------------------

def dirty_raw_csv(spark, sf_dir):
    """The dirty feed written as headerless CSV text, scanned back."""
    path = work_dir(spark, "rawcsv")
    C.write_text_lines(csv_lines(dirty_feed(_feed(spark, sf_dir))), path)
    return C.read_raw_csv(spark, path)


def q_scan_raw_csv(spark, sf_dir):
    raw = dirty_raw_csv(spark, sf_dir)
    return raw.select(
        "time_stamp", "store_name", "customer_name", "products", "total_price", "payment_type", "card_number",
        F.col("_corrupt_record").isNotNull().alias("is_corrupt"),
    )


def q_quarantine_reasons(spark, sf_dir):
    return Q.reason_counts(staging.stage(dirty_raw_csv(spark, sf_dir)))


def q_quarantine_rows(spark, sf_dir):
    """What is kept of rejected rows, fields missing left, middle and right among them."""
    path = work_dir(spark, "shiftedcsv")
    C.write_text_lines(shifted_lines(dirty_feed(_feed(spark, sf_dir))), path)
    wh = Warehouse(spark, work_dir(spark, "quarantine")).bootstrap()
    load_batch(wh, C.read_raw_csv(spark, path), 1, source="shifted")
    return wh.read("quarantine").select("reason", "time_stamp", "store_name", "total_price", "payment_type")


def q_quality_length(spark, sf_dir):
    return Q.length_violations(dirty_raw_csv(spark, sf_dir))


def _star_tables(wh):
    return {t: wh.read(t) for t in STAR_TABLES}


def q_quality_nulls(spark, sf_dir):
    return Q.null_counts(_star_tables(load_feed(spark, sf_dir, "one")))


def q_quality_orphans(spark, sf_dir):
    return Q.orphan_counts(_star_tables(load_feed(spark, sf_dir, "one")))


def q_quality_duplicates(spark, sf_dir):
    wh, valid = _loaded_valid(spark, sf_dir)
    star = Q.star_duplicates(_star_tables(wh))
    items = staging.parse_items(valid, keep=[])
    return star.unionByName(Q.product_price_conflicts(items))


def q_items_csv_roundtrip(spark, sf_dir):
    """S4 then S2: basket items of the loaded transactions through a header CSV."""
    txn = load_feed(spark, sf_dir, "one").staged_transactions[1]
    path = work_dir(spark, "itemscsv")
    C.write_items_csv(staging.parse_items(txn, keep=["transaction_id"]), path)
    return C.read_items_csv(spark, path)


def q_scan_header_csv(spark, sf_dir):
    """S3: the feed under the local variant's header names, through a CSV file."""
    path = work_dir(spark, "headercsv")
    C.write_header_csv(local_feed(_feed(spark, sf_dir)).drop("o_orderkey"), path)
    return C.read_header_csv(spark, path)


# ---- streaming and replay -------------------------------------------------

def q_stream_ingest(spark, sf_dir):
    """Feed 1 arrives, one triggered run; feed 2 arrives, another run."""
    from tillstar.streaming.ingest import run_available

    base = work_dir(spark, "stream")
    inbox, archive, ckpt = f"{base}/inbox", f"{base}/archive", f"{base}/checkpoint"
    wh = Warehouse(spark, f"{base}/warehouse").bootstrap()
    f1, f2 = feed_split(_feed(spark, sf_dir))
    for feed in (f1, f2):
        csv_lines(feed).select("value").write.mode("append").text(inbox)
        run_available(spark, inbox, wh, ckpt, archive_dir=archive)
    return star_view(wh)


def q_stream_archive(spark, sf_dir):
    """Two triggered runs; the rows of all files that the ledger-driven archive then holds."""
    from tillstar.streaming.ingest import run_available

    base = work_dir(spark, "archive")
    inbox, archive = f"{base}/inbox", f"{base}/archive"
    wh = Warehouse(spark, f"{base}/warehouse").bootstrap()
    for feed in feed_split(_feed(spark, sf_dir)):
        csv_lines(feed).select("value").write.mode("append").text(inbox)
        run_available(spark, inbox, wh, f"{base}/checkpoint", archive_dir=archive)
    raw = C.read_raw_csv(spark, archive)
    return raw.select("time_stamp", "store_name", "products", "total_price", "payment_type")


def q_replay_is_idempotent(spark, sf_dir):
    """A crash before the ledger row, a retry, then a replay."""
    wh = Warehouse(spark, work_dir(spark, "replay")).bootstrap()
    inbox = work_dir(spark, "replayfeed")
    f1, f2 = feed_split(materialize(_feed(spark, sf_dir), inbox))  # what arrived once is read again by each run
    load_batch(wh, f1.drop("o_orderkey"), 1, source="feed1")
    load_batch(wh, f2.drop("o_orderkey"), 2, source="feed2", commit=False)  # crash before commit
    load_batch(wh, f2.drop("o_orderkey"), 2, source="feed2")  # retry overwrites its partitions
    if not load_batch(wh, f2.drop("o_orderkey"), 2, source="feed2").skipped:  # replay: no-op
        raise AssertionError("a committed batch was loaded again")
    remove_dir(spark, inbox)
    return star_view(wh)


# ---- flat (local) variant ---------------------------------------------------
_FLAT: dict[tuple, DataFrame] = {}


def flat_frame(spark, sf_dir, reuse: bool = True) -> DataFrame:
    """X7 over the whole feed, written once to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if reuse and key in _FLAT:
        return _FLAT[key]
    scratch = work_dir(spark, "flat")
    flat = FL.flat_frame(local_feed(_feed(spark, sf_dir)), scratch, keep_order=True)
    flat = materialize(flat, f"{scratch}/frame")
    _FLAT[key] = flat
    return flat


def q_flat_frame(spark, sf_dir):
    return flat_frame(spark, sf_dir).select(*FL.FLAT_COLUMNS)


def q_group_numbers(spark, sf_dir):
    """A4: (key kind, key, number) of the five keys, from one pass over the sales and their items."""
    return FL.numbered_sales(local_feed(_feed(spark, sf_dir)), work_dir(spark, "groups"))[1].table


def q_flat_tables_products(spark, sf_dir):
    return FL.products_table(flat_frame(spark, sf_dir))


def q_flat_tables_sales(spark, sf_dir):
    return FL.sales_table(flat_frame(spark, sf_dir))


def q_flat_tables_orders(spark, sf_dir):
    return FL.orders_table(flat_frame(spark, sf_dir), work_dir(spark, "orders"))


def q_flat_tables_customers(spark, sf_dir):
    return FL.customers_table(flat_frame(spark, sf_dir))


def q_flat_tables_stores(spark, sf_dir):
    return FL.stores_table(flat_frame(spark, sf_dir))


def q_flat_tables_flavours(spark, sf_dir):
    return FL.flavours_table(flat_frame(spark, sf_dir))


def q_flat_tables_published(spark, sf_dir):
    """The six tables staged, audited and published; rows of each as published."""
    out = work_dir(spark, "flatout")
    FL.write_flat_tables(flat_frame(spark, sf_dir), out, work_dir(spark, "flatscratch"))
    counts = [
        spark.read.parquet(f"{out}/{t}").agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows")) for t in FL.FLAT_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def q_insert_or_fail(spark, sf_dir):
    """Customers with odd keys inserted after those with even ones; a known or repeated key fails the insert."""
    configure(spark)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    even, odd = c.where("c_custkey % 2 = 0"), c.where("c_custkey % 2 = 1")
    for rows in (even, odd.union(odd)):
        try:
            FL.insert_or_fail(even, rows, ["c_custkey"])
        except FL.KeyConflictError:
            continue
        raise AssertionError("a conflicting insert went through")
    return FL.insert_or_fail(even, odd, ["c_custkey"])


def q_insert_ignore(spark, sf_dir):
    """Customers of feed 1, then every row of the feed inserted with ON CONFLICT DO NOTHING."""
    flat = flat_frame(spark, sf_dir)
    feed1 = flat.where(F.col("o_orderkey") < FEED1_MAX_ORDERKEY)
    target = feed1.groupBy("customer_name").agg(
        F.min_by("customer_id", F.struct("o_orderkey", "item_pos")).alias("customer_id")
    ).select("customer_id", "customer_name")
    rows = flat.select("customer_id", "customer_name", F.struct("o_orderkey", "item_pos").alias("_order"))
    return FL.insert_ignore(target, rows, ["customer_name"], "_order")


# ---- row-list operators -----------------------------------------------------
# IN-list of nation keys (fixed value).
IN_LIST = [1, 3, 5]
# Price updates (fixed values); the last key is unknown to `part`.
PRICE_UPDATES = [(0, 1.5), (1, 2.25), (2, 3.0), (3, 4.75), (5, 5.5), (8, 6.25), (13, 7.0), (21, 8.75), (34, 9.5), (999999999, 10.0)]
# Dirty column names and the source column behind each (fixed values).
DIRTY_NAMES = [("o_orderkey", "1st"), ("total_price", "total price"), ("store_name", "_x"), ("customer_name", "a-b"), ("payment_type", "ok_1")]


def q_filter_in_list(spark, sf_dir):
    configure(spark)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return R.filter_in(c, "c_nationkey", IN_LIST)


def q_clean_column_names(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    return R.clean_column_names(feed.select(*[F.col(src).alias(dirty) for src, dirty in DIRTY_NAMES]))


def q_update_from_rows(spark, sf_dir):
    configure(spark)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    upd = spark.createDataFrame(PRICE_UPDATES, "p_partkey bigint, p_retailprice double")
    return R.update_from_rows(part, upd, ["p_partkey"], ["p_retailprice"])


# Whole-row updates (fixed values): one key twice, NULL in either column, an unknown key.
ROW_UPDATES = [(0, "first", 1.5), (1, None, 2.25), (1, "second", 9.0), (8, "third", None), (13, None, None), (999999999, "none", 1.0)]


def q_update_files(spark, sf_dir):
    """J8 as copy on write: ``part`` in many files by key, two columns of a few rows updated."""
    base = work_dir(spark, "updatefiles")
    _part(spark, sf_dir).select("p_partkey", "p_name", "p_retailprice").repartitionByRange(16, "p_partkey").write.parquet(f"{base}/part")
    upd = spark.createDataFrame(ROW_UPDATES, "p_partkey bigint, p_name string, p_retailprice double")
    done = R.update_files(spark, f"{base}/part", upd, ["p_partkey"], ["p_name", "p_retailprice"], f"{base}/new")
    if not done.kept or not done.touched:
        raise AssertionError("all or none of the files were written anew")
    return done.frame


def q_insert_rows(spark, sf_dir):
    """J8, insert form: parts with odd keys appended to those with even ones."""
    p = _part(spark, sf_dir).select("p_partkey", "p_name", "p_retailprice")
    return R.insert_rows(p.where("p_partkey % 2 = 0"), p.where("p_partkey % 2 = 1"))


# ---- Postgres column types ---------------------------------------------------

def _part(spark, sf_dir):
    configure(spark)
    return table(spark, sf_dir, "part")


def _parsed_ranges(spark, sf_dir):
    r = X.part_ranges(_part(spark, sf_dir))
    return r.select("p_partkey", PG.range_parse("range_text").alias("range"))


def q_range_parse(spark, sf_dir):
    r = _parsed_ranges(spark, sf_dir)
    return r.select("p_partkey", "range.lower", "range.upper", "range.bounds", "range.valid")


def q_range_bounds(spark, sf_dir):
    r = _parsed_ranges(spark, sf_dir)
    return r.select(
        "p_partkey",
        PG.range_isempty("range").alias("isempty"),
        PG.range_lower_inf("range").alias("lower_inf"),
        PG.range_upper_inf("range").alias("upper_inf"),
        PG.range_lower_inc("range").alias("lower_inc"),
        PG.range_upper_inc("range").alias("upper_inc"),
    )


def q_range_contains(spark, sf_dir):
    r = _parsed_ranges(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    j = li.join(r, li.l_partkey == r.p_partkey)
    return j.select("l_orderkey", "l_linenumber", PG.range_contains("range", "l_quantity").alias("in_range"))


def q_range_order(spark, sf_dir):
    r = _parsed_ranges(spark, sf_dir).select("p_partkey", "range.lower", "range.upper", "range.bounds")
    keys = ["lower", "upper", "bounds"]
    pos = ordered_ids_ranged(r, keys + ["p_partkey"], "pos", work_dir(spark, "rangeorder"))
    eq = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_equal"))
    cond = [pos[k].eqNullSafe(eq[k]) for k in keys]
    return pos.join(eq, cond).select(pos["p_partkey"], pos["pos"], eq["n_equal"])


def q_range_format(spark, sf_dir):
    r = X.part_range_struct(_part(spark, sf_dir))
    return r.select("p_partkey", PG.range_format("range").alias("range_text"))


def _events(spark, sf_dir):
    configure(spark)
    return table(spark, sf_dir, "events")


def q_json_decode(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("event_id", PG.json_get(PG.json_decode("props"), "$.k", "int").alias("k"))


def q_json_encode(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("event_id", PG.json_encode(F.struct("event_id", "event_type", "user_id")).alias("json_text"))


def q_json_array_explode(spark, sf_dir):
    configure(spark)
    j = X.order_partkey_json(table(spark, sf_dir, "lineitem"))
    return j.select("l_orderkey", F.posexplode(PG.json_array_elements("parts_json", "bigint")).alias("pos", "l_partkey"))


def q_hstore_decode(spark, sf_dir):
    h = X.hstore_text(_part(spark, sf_dir))
    return h.select("p_partkey", F.explode(PG.hstore_decode("hstore")).alias("key", "value"))


def q_hstore_encode(spark, sf_dir):
    p = _part(spark, sf_dir)
    size = F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("p_size").cast("string"))
    m = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"), F.lit("size"), size)
    return p.select("p_partkey", PG.hstore_encode(m).alias("hstore_text"))


COMPOSITE_FIELDS = [("name", "string"), ("size", "int"), ("price", "decimal(10,2)")]


def q_composite_decode(spark, sf_dir):
    c = X.composite_text(_part(spark, sf_dir))
    s = PG.composite_decode("composite", COMPOSITE_FIELDS).alias("v")
    return c.select("p_partkey", s).select("p_partkey", "v.name", "v.size", "v.price", "v.valid")


def q_offset_to_utc(spark, sf_dir):
    e = X.event_offsets(_events(spark, sf_dir))
    return e.select(
        "event_id",
        PG.offset_to_utc("ts", "offset_minutes").alias("utc_ts"),
        PG.offset_label("offset_minutes").alias("offset_label"),
    )


def q_range_malformed(spark, sf_dir):
    """G1 on texts of which most are no ranges."""
    r = X.odd_ranges(_part(spark, sf_dir)).select("p_partkey", PG.range_parse("range_text").alias("r"))
    return r.select("p_partkey", "r.lower", "r.upper", "r.bounds", "r.valid")


def q_composite_malformed(spark, sf_dir):
    """G11 on texts with doubled quotes, escapes, missing fields and values of another type."""
    c = X.odd_composites(_part(spark, sf_dir)).select("p_partkey", PG.composite_decode("composite", COMPOSITE_FIELDS).alias("v"))
    return c.select("p_partkey", "v.name", "v.size", "v.price", "v.valid")


def q_hstore_malformed(spark, sf_dir):
    """G9 on texts with escapes, white space, repeated keys and broken pairs."""
    h = X.odd_hstores(_part(spark, sf_dir))
    h = h.select("p_partkey", PG.hstore_valid("hstore").alias("valid"), PG.hstore_decode("hstore").alias("m"))
    return h.select("p_partkey", "valid", F.explode_outer("m").alias("key", "value"))


def q_offset_seconds(spark, sf_dir):
    """G12 with offsets that are no whole minutes."""
    e = X.event_offsets_with_seconds(_events(spark, sf_dir))
    return e.select(
        "event_id",
        PG.offset_to_utc("ts", "offset_minutes", "offset_seconds").alias("utc_ts"),
        PG.offset_label("offset_minutes", "offset_seconds").alias("offset_label"),
    )


def q_range_join(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "value")
    bands = spark.createDataFrame([(b,) for b in X.PRICE_BANDS], "band string")
    bands = bands.select("band", PG.range_parse("band", "decimal(10,2)").alias("range"))
    bands = bands.where(F.col("range.valid"))  # the unparsable band is rejected
    return range_join(e, "value", bands).select("event_id", "value", "band")


def _domain_join(spark, sf_dir, facts, value, domain, kind):
    r = X.domain_ranges(_part(spark, sf_dir), domain)
    r = r.select("p_partkey", PG.range_parse("range_text", kind).alias("range"))
    return range_join(facts, value, r).drop("range")


def q_range_join_many(spark, sf_dir):
    """J9 with a range per part, some open, one of them far wider than the facts."""
    return _domain_join(spark, sf_dir, _events(spark, sf_dir).select("event_id", "value"), "value", "price", "decimal(10,2)")


def q_range_join_days(spark, sf_dir):
    configure(spark)
    day = F.col("o_orderdate").cast("date")
    # the day's text is made once per order, not once per pair
    o = table(spark, sf_dir, "orders").select("o_orderkey", day.cast("string").alias("order_day"), day.alias("_day"))
    return _domain_join(spark, sf_dir, o, "_day", "day", "date").drop("_day")


def q_range_join_times(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    return _domain_join(spark, sf_dir, e, "ts", "time", "timestamp_ntz")


QUERIES: dict[str, Query] = {
    # 2.1 scans, sources, sinks; 2.8 streaming
    "scan_raw_csv": q_scan_raw_csv,
    "items_csv_roundtrip": q_items_csv_roundtrip,
    "scan_header_csv": q_scan_header_csv,
    "stream_ingest": q_stream_ingest,
    "stream_archive": q_stream_archive,
    "replay_is_idempotent": q_replay_is_idempotent,
    # 2.2 projections, filters, predicates; 2.6 basket functions
    "stage_transactions": q_stage_transactions,
    "explode_baskets": q_explode_baskets,
    "parse_items": q_parse_items,
    "filter_in_list": q_filter_in_list,
    "clean_column_names": q_clean_column_names,
    # 2.3 joins, 2.4 distinct and ids
    "distinct_stores": q_distinct_stores,
    "distinct_customers": q_distinct_customers,
    "distinct_products": q_distinct_products,
    "distinct_flavours": q_distinct_flavours,
    "dim_stores_incremental": _dim("stores"),
    "dim_customers_incremental": _dim("customers"),
    "dim_products_incremental": _dim("products"),
    "dim_flavours_incremental": _dim("flavours"),
    "lookup_store": q_lookup_store,
    "lookup_customer": q_lookup_customer,
    "lookup_customer_by_name": q_lookup_customer_by_name,
    "transaction_id_backfill": q_transaction_id_backfill,
    "update_from_rows": q_update_from_rows,
    "update_files": q_update_files,
    "insert_rows": q_insert_rows,
    "range_join": q_range_join,
    "range_join_many": q_range_join_many,
    "range_join_days": q_range_join_days,
    "range_join_times": q_range_join_times,
    # 2.4-2.6 flat variant
    "flat_frame": q_flat_frame,
    "group_numbers": q_group_numbers,
    "flat_tables_products": q_flat_tables_products,
    "flat_tables_sales": q_flat_tables_sales,
    "flat_tables_orders": q_flat_tables_orders,
    "flat_tables_customers": q_flat_tables_customers,
    "flat_tables_stores": q_flat_tables_stores,
    "flat_tables_flavours": q_flat_tables_flavours,
    "flat_tables_published": q_flat_tables_published,
    "insert_ignore": q_insert_ignore,
    "insert_or_fail": q_insert_or_fail,
    # 2.7 Postgres column types
    "range_parse": q_range_parse,
    "range_bounds": q_range_bounds,
    "range_contains": q_range_contains,
    "range_order": q_range_order,
    "range_format": q_range_format,
    "json_decode": q_json_decode,
    "json_encode": q_json_encode,
    "json_array_explode": q_json_array_explode,
    "hstore_decode": q_hstore_decode,
    "hstore_encode": q_hstore_encode,
    "composite_decode": q_composite_decode,
    "offset_to_utc": q_offset_to_utc,
    "range_malformed": q_range_malformed,
    "composite_malformed": q_composite_malformed,
    "hstore_malformed": q_hstore_malformed,
    "offset_seconds": q_offset_seconds,
    # 2.10 constraint audits
    "quality_length": q_quality_length,
    "quality_nulls": q_quality_nulls,
    "quality_duplicates": q_quality_duplicates,
    "quality_orphans": q_quality_orphans,
    "quarantine_reasons": q_quarantine_reasons,
    "quarantine_rows": q_quarantine_rows,
    # 2.11 flagship
    "star_load": q_star_load,
    "star_load_two_batches": q_star_load_two_batches,
    "fact_transactions": q_fact_transactions,
    "basket_lines": q_basket_lines,
}
