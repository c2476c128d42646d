"""Local flat variant golden rows, quality audits and feed properties."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstar.operators import flat as FL
from tillstar.operators import quality as Q
from tillstar.plans import staging
from tillstar.plans.load import Warehouse, load_batch
from tillstar.sources.csv import read_raw_csv, write_text_lines
from tillstar.sources.feed import csv_lines, dirty_feed, feed_split, sales_feed


def test_local_variant_golden(spark, tmp_dir):
    local = spark.createDataFrame(
        [
            (1, "01-02-2024 09:00:00", "North", "Ann", "Tea - 1.30", 1.3, "CASH", None),
            (2, "01-02-2024 09:05:00", "North", "Bo", "Latte - Mint - 2.75, Tea - 1.30", 4.05, "CARD", "4444"),
        ],
        "o_orderkey long, timestamp string, store string, customer_name string, basket_items string, "
        "total_price double, cash_or_card string, card_number string",
    )
    flat = FL.flat_frame(local, tmp_dir, keep_order=True)
    got = sorted((r.o_orderkey, r.item_pos, r.item, r.flavour, r.price, r.item_id, r.flavour_id) for r in flat.collect())
    assert got == [
        (1, 0, "Tea ", " ", " 1.30", 1, 0),
        (2, 0, "Latte ", " Mint ", " 2.75", 0, 1),
        (2, 1, "Tea ", " ", " 1.30", 1, 0),
    ]
    assert "card_number" not in flat.columns
    products = sorted(tuple(r) for r in FL.products_table(flat).collect())
    assert [(p[0], p[1], str(p[2])) for p in products] == [(0, "Latte ", "2.75"), (1, "Tea ", "1.30")]
    orders = sorted(tuple(r) for r in FL.orders_table(flat, f"{tmp_dir}/o").collect())
    assert orders == [(1, 1, 0, 0), (2, 0, 1, 1), (3, 1, 0, 1)]


def test_one_part_item_pads_with_space(spark, tmp_dir):
    local = spark.createDataFrame(
        [(1, "t", "s", "c", "Tea", 1.0, "CASH", None)],
        "o_orderkey long, timestamp string, store string, customer_name string, basket_items string, "
        "total_price double, cash_or_card string, card_number string",
    )
    r = FL.explode_items(local).first()
    assert (r.item, r.flavour, r.price) == (" ", " ", "Tea")


def test_dirty_feed_reasons(spark, tmp_dir):
    feed = sales_feed(spark, SF_SMALL)
    write_text_lines(csv_lines(dirty_feed(feed)), f"{tmp_dir}/raw")
    raw = read_raw_csv(spark, f"{tmp_dir}/raw")
    counts = {r.reason: r.n_rows for r in Q.reason_counts(staging.stage(raw)).collect()}
    assert set(counts) == {"ok", "corrupt_row", "bad_timestamp", "bad_total", "bad_price", "too_long"}
    assert sum(counts.values()) == feed.count()
    lengths = {r.column_name: r.n_over for r in Q.length_violations(raw).collect()}
    assert lengths["store_name"] > 0 and lengths["products"] == 0


def test_properties_of_a_load(spark, tmp_dir):
    """Ids dense 1..n; every line joins one transaction/product/flavour;
    lines = split parts; two batches equal one up to id renaming."""
    feed = sales_feed(spark, SF_SMALL)
    one = Warehouse(spark, f"{tmp_dir}/one").bootstrap()
    load_batch(one, feed.drop("o_orderkey"), 1)
    two = Warehouse(spark, f"{tmp_dir}/two").bootstrap()
    f1, f2 = feed_split(feed)
    load_batch(two, f1.drop("o_orderkey"), 1)
    load_batch(two, f2.drop("o_orderkey"), 2)

    for wh in (one, two):
        for t, k in [("stores", "store_id"), ("customers", "customer_id"), ("products", "product_id"),
                     ("flavours", "flavour_id"), ("transactions", "transaction_id")]:
            ids = sorted(r[0] for r in wh.read(t).select(k).collect())
            assert ids == list(range(1, len(ids) + 1)), t
        b = wh.read("baskets")
        for t, k in [("transactions", "transaction_id"), ("products", "product_id"), ("flavours", "flavour_id")]:
            assert b.join(wh.read(t), k, "left_anti").count() == 0
        n_parts = feed.select(F.sum(F.size(F.split("products", ", "))).alias("n")).first().n
        assert b.count() == n_parts

    def natural(wh):
        t = wh.read("transactions").join(wh.read("stores"), "store_id").join(wh.read("customers").drop("store_id"), "customer_id")
        b = wh.read("baskets").join(wh.read("products").drop("price"), "product_id").join(wh.read("flavours"), "flavour_id")
        j = t.join(b, "transaction_id")
        return sorted(tuple(r) for r in j.select("time_stamp", "store_name", "customer_name", "total_price", "product_name", "flavour_name").collect())

    assert natural(one) == natural(two)


def test_flat_tables_written_and_insert_or_fail(spark, tmp_dir):
    import pytest

    from tillstar.sources.feed import local_feed

    flat = FL.flat_frame(local_feed(sales_feed(spark, SF_SMALL)), f"{tmp_dir}/s", keep_order=True)
    FL.write_flat_tables(flat, f"{tmp_dir}/out", f"{tmp_dir}/s2")
    for t in ("customers", "stores", "products", "flavours", "sales", "orders"):
        assert spark.read.parquet(f"{tmp_dir}/out/{t}").count() > 0
    stores = spark.read.parquet(f"{tmp_dir}/out/stores")
    with pytest.raises(FL.KeyConflictError):
        FL.insert_or_fail(stores, stores.limit(1), ["store_name"])
    extra = spark.createDataFrame([(99, "NEW")], "store_id long, store_name string")
    assert FL.insert_or_fail(stores, extra, ["store_name"]).count() == stores.count() + 1


def test_scratch_dropped_after_commit(spark, tmp_dir):
    import os

    feed = sales_feed(spark, SF_SMALL)
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    load_batch(wh, feed.drop("o_orderkey"), 1)
    scratch = f"{tmp_dir}/wh/_scratch"
    assert not os.path.exists(scratch) or os.listdir(scratch) == []
    assert wh.read("transactions").count() == feed.count()


def test_command_line_flat(spark, tmp_dir):
    import os

    from tillstar.__main__ import main

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/local.csv", "w") as f:
        f.write("timestamp,store,customer_name,basket_items,total_price,cash_or_card,card_number\n")
        f.write("01-02-2024 09:00:00,North,Ann,Tea - 1.30,1.3,CASH,\n")
        f.write('01-02-2024 09:05:00,North,Bo,"Latte - Mint - 2.75, Tea - 1.30",4.05,CARD,4444\n')
    assert main(["flat", f"{tmp_dir}/in", f"{tmp_dir}/out"]) == 0
    products = sorted((r.product_id, r.product_name, str(r.price)) for r in spark.read.parquet(f"{tmp_dir}/out/products").collect())
    assert products == [(0, "Latte ", "2.75"), (1, "Tea ", "1.30")]
    orders = spark.read.parquet(f"{tmp_dir}/out/orders")
    assert sorted(r.order_id for r in orders.collect()) == [1, 2, 3]
