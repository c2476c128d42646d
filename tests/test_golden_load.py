"""Golden edge rows through the whole load (batch, replay, streaming)."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from golden import ANN, BO, EMPTY, FEED1, FEED2, write
from tillstar.operators import dims as D
from tillstar.plans.load import BadRowsError, Warehouse, load_batch, star_view
from tillstar.plans import staging
from tillstar.sources.csv import read_raw_csv


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture()
def loaded(spark, tmp_dir):
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    load_batch(wh, read_raw_csv(spark, f1), 1, source="feed1")
    return wh, tmp_dir


def test_feed1_dimensions(loaded):
    wh, _ = loaded
    assert rows(wh.read("stores"), "store_id", "store_name") == [(1, "North"), (2, "South")]
    assert rows(wh.read("customers"), "customer_id", "customer_name", "store_id") == [
        (1, ANN, 1), (2, ANN, 2), (3, EMPTY, 2)]
    assert rows(wh.read("products"), "product_id", "product_name", "price") == [
        (1, "Large Latte", Decimal("2.75")), (2, "Mocha", Decimal("3.10")), (3, "Tea", Decimal("1.30"))]
    assert rows(wh.read("flavours"), "flavour_id", "flavour_name") == [(1, ""), (2, "Hazelnut"), (3, "Mint")]


def test_feed1_facts(loaded):
    wh, _ = loaded
    t = rows(wh.read("transactions"), "transaction_id", "time_stamp", "store_id", "customer_id", "total_price", "payment_type")
    nine = dt.datetime(2024, 2, 1, 9, 0)
    assert t == [
        (1, nine, 1, 1, Decimal("2.60"), "CASH"),
        (2, nine, 1, 1, Decimal("2.60"), "CASH"),
        (3, nine, 1, 1, Decimal("4.05"), "CARD"),
        (4, dt.datetime(2024, 2, 1, 9, 5), 2, 2, Decimal("2.95"), "CASH"),
        (5, dt.datetime(2024, 2, 1, 9, 6), 2, 3, Decimal("3.10"), "CASH"),
    ]
    b = rows(wh.read("baskets"), "transaction_id", "product_id", "flavour_id")
    assert b == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 1, 2), (3, 3, 1), (4, 1, 2), (5, 2, 3)])


def test_feed1_quarantine(loaded):
    wh, _ = loaded
    q = wh.read("quarantine")
    assert sorted(r[0] for r in q.select("reason").collect()) == ["bad_price", "bad_timestamp", "bad_total", "corrupt_row"]
    # nothing personal in the quarantine
    assert "customer_name" not in q.columns and "card_number" not in q.columns
    assert q.where(F.col("line_md5").isNull()).count() == 0


def test_card_number_never_written(loaded):
    wh, tmp = loaded
    for root, _, files in os.walk(wh.root):
        for f in files:
            if f.endswith(".parquet"):
                data = open(os.path.join(root, f), "rb").read()
                assert b"4444000011112222" not in data


def test_lookup_customer_by_name_reference_mode(spark, loaded):
    wh, tmp = loaded
    valid = staging.valid_rows(staging.stage(read_raw_csv(spark, f"{tmp}/feed1")))
    v = D.lookup_store(valid, wh.read("stores"))
    ann = D.lookup_customer_by_name(v, wh.read("customers")).where(F.col("customer_name") == ANN)
    assert {r[0] for r in ann.select("customer_id").collect()} == {1}
    by_key = D.lookup_customer(v, wh.read("customers")).where(F.col("customer_name") == ANN)
    assert {tuple(r) for r in by_key.select("store_id", "customer_id").collect()} == {(1, 1), (2, 2)}


def test_feed2_and_replay(spark, loaded):
    wh, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh, read_raw_csv(spark, f2), 2, source="feed2")
    assert (3, "East") in rows(wh.read("stores"), "store_id", "store_name")
    assert (4, BO, 3) in rows(wh.read("customers"), "customer_id", "customer_name", "store_id")
    products = rows(wh.read("products"), "product_id", "product_name", "price")
    assert (4, "Cocoa", Decimal("2.00")) in products and (3, "Tea", Decimal("1.30")) in products
    assert (4, "Cherry") in rows(wh.read("flavours"), "flavour_id", "flavour_name")
    assert rows(wh.read("baskets").where("transaction_id = 6"), "transaction_id", "product_id", "flavour_id") == [(6, 3, 1), (6, 4, 4)]
    before = rows(star_view(wh), *star_view(wh).columns)
    assert load_batch(wh, read_raw_csv(spark, f2), 2, source="feed2").skipped
    assert rows(star_view(wh), *star_view(wh).columns) == before


def test_retry_after_crash_overwrites(spark, loaded):
    wh, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh, read_raw_csv(spark, f2), 2, source="feed2", commit=False)
    # not visible before the ledger row
    assert wh.read("transactions").where("transaction_id = 6").count() == 0
    load_batch(wh, read_raw_csv(spark, f2), 2, source="feed2")
    assert wh.read("transactions").count() == 6
    assert wh.read("baskets").count() == 10


def test_fail_mode(spark, tmp_dir):
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    with pytest.raises(BadRowsError):
        load_batch(wh, read_raw_csv(spark, f1), 1, on_bad_row="fail")
    assert wh.ledger().count() == 0


def test_stream_matches_batch(spark, loaded):
    from tillstar.streaming.ingest import run_available

    wh_batch, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh_batch, read_raw_csv(spark, f2), 2, source="feed2")

    inbox, ckpt = f"{tmp}/inbox", f"{tmp}/ckpt"
    wh = Warehouse(spark, f"{tmp}/wh_stream").bootstrap()
    write(inbox, "a.csv", FEED1)
    run_available(spark, inbox, wh, ckpt, max_files_per_trigger=1)
    write(inbox, "b.csv", FEED2)
    run_available(spark, inbox, wh, ckpt, max_files_per_trigger=1)
    # a restart with nothing new changes nothing
    run_available(spark, inbox, wh, ckpt, max_files_per_trigger=1)
    cols = star_view(wh).columns
    assert rows(star_view(wh), *cols) == rows(star_view(wh_batch), *cols)
    assert sorted(r[0] for r in wh.ledger().select("batch_id").collect()) == [1, 2]


def test_bootstrap_schema_is_idempotent(spark, tmp_dir):
    from tillstar.plans.load import star_schema_columns

    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap().bootstrap()
    cols = star_schema_columns(wh)
    got = {(r.table_name, r.column_name): r.data_type for r in cols.collect()}
    assert got[("transactions", "time_stamp")] == "timestamp_ntz"
    assert got[("products", "price")] == "decimal(10,2)"
    assert got[("customers", "customer_id")] == "bigint"
    assert len({t for t, _ in got}) == 6


def test_shuffle_path_equals_broadcast_path(spark, tmp_dir, monkeypatch):
    """With every broadcast refused the load is the same."""
    from tillstar.operators import dims

    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    f2 = os.path.dirname(write(f"{tmp_dir}/feed2", "b.csv", FEED2))
    results = []
    for limit in (dims.BROADCAST_MAX_BYTES, 0):
        # 0: no broadcast is forced, as with very large batches
        monkeypatch.setattr(dims, "BROADCAST_MAX_BYTES", limit)
        wh = Warehouse(spark, f"{tmp_dir}/wh{limit}").bootstrap()
        load_batch(wh, read_raw_csv(spark, f1), 1)
        load_batch(wh, read_raw_csv(spark, f2), 2)
        results.append(rows(star_view(wh), *star_view(wh).columns))
    assert results[0] == results[1]


def test_name_only_lookup_and_salt(spark, tmp_dir):
    """H1 reference mode: every sale of a name gets its lowest customer id.
    H9: a salted digest replaces MD5 without changing the ids' structure."""
    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    load_batch(wh, read_raw_csv(spark, f1), 1, customer_lookup="name_only")
    t = rows(wh.read("transactions"), "transaction_id", "store_id", "customer_id")
    # the South sale of Ann Ode (transaction 4) points at customer 1 (North) in reference mode
    assert (4, 2, 1) in t
    salted = Warehouse(spark, f"{tmp_dir}/salted").bootstrap()
    load_batch(salted, read_raw_csv(spark, f1), 1, salt="pepper")
    names = {r[0] for r in salted.read("customers").select("customer_name").collect()}
    assert ANN not in names and all(len(n) == 64 for n in names)
    assert salted.read("transactions").count() == 5


def test_incremental_audit_of_a_batch(spark, loaded):
    from tillstar.plans.audit import audit_batch

    wh, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh, read_raw_csv(spark, f2), 2)
    rep = audit_batch(wh, 2)
    assert sum(r.n_null for r in rep["nulls"].collect()) == 0
    assert rep["duplicates"].count() == 0
    assert sum(r.n_orphans for r in rep["orphans"].collect()) == 0
    # an orphan planted in the next batch's partition is found
    spark.createDataFrame([(999, 1, 1, 3)], "transaction_id long, product_id long, flavour_id long, batch_id long") \
        .write.mode("append").partitionBy("batch_id").parquet(wh.path("baskets"))
    orph = {(r.child_table, r.parent_table): r.n_orphans for r in audit_batch(wh, 3)["orphans"].collect()}
    assert orph[("baskets", "transactions")] == 1


def test_batch_of_only_bad_rows(spark, tmp_dir):
    bad = "\n".join(FEED1.strip().splitlines()[5:]) + "\n"  # the four rejected rows only
    f = os.path.dirname(write(f"{tmp_dir}/bad", "c.csv", bad))
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    load_batch(wh, read_raw_csv(spark, f), 1)
    assert wh.read("quarantine").count() == 4
    assert wh.read("transactions").count() == 0 and wh.read("stores").count() == 0
    led = wh.ledger().first()
    assert (led.batch_id, led.max_transaction_id, led.max_store_id) == (1, 0, 0)
    # the next batch starts its ids at 1
    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    load_batch(wh, read_raw_csv(spark, f1), 2)
    assert sorted(r[0] for r in wh.read("transactions").select("transaction_id").collect()) == [1, 2, 3, 4, 5]


def test_rerun_with_fewer_rows_leaves_nothing_stale(spark, loaded):
    """A crashed attempt wrote a new store; the rerun of the batch has none."""
    wh, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh, read_raw_csv(spark, f2), 2, commit=False)  # writes store East, then crashes
    other = "03-02-2024 10:00:00,North,Ann Ode,\"Tea - 1.30\",1.30,CASH,\n"
    f3 = os.path.dirname(write(f"{tmp}/feed3", "c.csv", other))
    load_batch(wh, read_raw_csv(spark, f3), 2)
    assert rows(wh.read("stores"), "store_id", "store_name") == [(1, "North"), (2, "South")]
    assert wh.read("customers").count() == 3 and wh.read("flavours").count() == 3
    assert wh.read("transactions").count() == 6


def test_command_line(spark, tmp_dir, capsys):
    from tillstar.__main__ import main

    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    assert main(["load", f1, f"{tmp_dir}/wh"]) == 0
    assert main(["load", f1, f"{tmp_dir}/wh", "--batch-id", "1"]) == 0
    out = capsys.readouterr().out
    assert "batch 1: committed" in out and "batch 1: already loaded" in out
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    assert wh.read("transactions").count() == 5


def test_redelivered_micro_batch_is_skipped(spark, tmp_dir):
    """Spark re-delivers a micro-batch after a crash between the warehouse
    commit and its own checkpoint commit; the ledger key makes it a no-op."""
    from tillstar.streaming.ingest import micro_batch_loader

    ckpt = f"{tmp_dir}/ckpt"
    write(ckpt, "metadata", '{"id":"3f1b3c1e-0000-4000-8000-000000000001"}\n')
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    f1 = os.path.dirname(write(f"{tmp_dir}/feed1", "a.csv", FEED1))
    f2 = os.path.dirname(write(f"{tmp_dir}/feed2", "b.csv", FEED2))
    load = micro_batch_loader(wh, ckpt)
    load(read_raw_csv(spark, f1), 0)
    load(read_raw_csv(spark, f1), 0)  # re-delivery of micro-batch 0
    load(read_raw_csv(spark, f2), 1)
    assert sorted(r[0] for r in wh.ledger().select("batch_id").collect()) == [1, 2]
    assert wh.read("transactions").count() == 6


def test_star_view_of_one_batch_prunes_partitions(spark, loaded):
    wh, tmp = loaded
    f2 = os.path.dirname(write(f"{tmp}/feed2", "b.csv", FEED2))
    load_batch(wh, read_raw_csv(spark, f2), 2)
    one = star_view(wh, batches=[2])
    assert rows(one, "transaction_id", "product_id") == [(6, 3), (6, 4)]
    import re

    plan = one._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[[^\]]*\(batch_id#\d+L = 2\)\]", plan)
    assert len(pruned) == 2  # transactions and baskets scans both prune to batch 2


def test_hot_group_of_identical_sales_stays_whole(spark, tmp_dir):
    """600 identical sales (most of the batch): every copy gets its own dense
    id and exactly its own two basket lines."""
    hot = '01-02-2024 09:00:00,North,Ann Ode,"Tea - 1.30, Tea - 1.30",2.60,CASH,\n'
    other = '01-02-2024 09:05:00,South,Bo Lin,"Mocha - Mint - 3.10",3.10,CARD,4444000011112222\n'
    write(f"{tmp_dir}/hot", "a.csv", hot * 600 + other * 300)
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    load_batch(wh, read_raw_csv(spark, f"{tmp_dir}/hot"), 1)
    ids = sorted(r[0] for r in wh.read("transactions").select("transaction_id").collect())
    assert ids == list(range(1, 901))
    per_txn = wh.read("baskets").groupBy("transaction_id").count()
    assert per_txn.count() == 900
    counts = {r[0]: r[1] for r in per_txn.groupBy("count").count().collect()}
    assert counts == {2: 600, 1: 300}
    # the hot copies take the first ids (2.60 CASH at 09:00 sorts first)
    hot_ids = wh.read("transactions").where("total_price = 2.60").select("transaction_id")
    assert sorted(r[0] for r in hot_ids.collect()) == list(range(1, 601))
