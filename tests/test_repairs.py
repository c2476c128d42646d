"""Values that are malformed, shifted, escaped or NULL are reported or kept, not turned into answers."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillstar.functions import pgtypes as PG
from tillstar.operators import flat as FL
from tillstar.operators import rows as R
from tillstar.plans import staging
from tillstar.plans.claim import Claim, LoadInProgress
from tillstar.plans.load import BadRowsError, Warehouse, load_batch
from tillstar.sources import csv as C


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def test_malformed_ranges_are_not_valid(spark):
    bad = ["[abc,5)", "[1.5,5)", "[1,99999999999999999999)", "[5,1)", "[1,2", "1,2)", "x[1,2)", "[1,2,3)", "", None, "[1 2,3)"]
    got = texts(spark, bad).select("i", PG.range_parse("t").alias("r")).select("i", "r.*").collect()
    assert [r for r in got if r.valid or r.lower is not None or r.upper is not None or r.bounds is not None] == []
    good = ["[1,2)", " (,7] ", "[,]", "empty", '["3","4"]', "[5,5]"]
    got = texts(spark, good).select("i", PG.range_parse("t").alias("r")).orderBy("i").select("r.*").collect()
    assert [tuple(r) for r in got] == [
        (1, 2, "[)", True), (None, 7, "(]", True), (None, None, "[]", True), (None, None, None, True), (3, 4, "[]", True), (5, 5, "[]", True),
    ]


def test_text_and_timestamp_ranges_survive_a_write(spark):
    rows = [('a,b', 'c"d', "[)"), ("(x", "y\\z]", "[]"), (None, " lead", "()"), ("", "b", "[]"), ("p q", None, "[)")]
    df = spark.createDataFrame(rows, "lo string, hi string, b string").select("*", PG.make_range("lo", "hi", F.col("b")).alias("r"))
    back = df.select("lo", "hi", "b", PG.range_parse(PG.range_format("r"), "string").alias("p")).collect()
    for x in back:
        assert x.p.valid and (x.p.lower, x.p.upper, x.p.bounds) == (x.lo, x.hi, x.b)
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), None)], "lo timestamp_ntz, hi timestamp_ntz")
    x = ts.select("lo", PG.range_parse(PG.range_format(PG.make_range("lo", "hi")), "timestamp_ntz").alias("p")).first()
    assert x.p.lower == x.lo and x.p.valid


def test_malformed_and_escaped_composites(spark):
    fields = [("name", "string"), ("size", "int"), ("price", "double")]
    cases = {
        '("x",abc,1.0)': None, "junk,2,3)": None, "(a,2,3": None, "(a,2)": None, "(a,2,3,4)": None,
        r'("a\"b",2,3)': ('a"b', 2, 3.0), '("a""b",2,3)': ('a"b', 2, 3.0), '("a,b)",2,)': ("a,b)", 2, None), "(,,)": (None, None, None),
        '("",2,3)': ("", 2, 3.0), r"(a\,b,2,3)": ("a,b", 2, 3.0), ' ( a,2,3) ': (" a", 2, 3.0), r'("a\\",2,3)': ("a\\", 2, 3.0),
    }
    got = texts(spark, list(cases)).select("t", PG.composite_decode("t", fields).alias("c")).collect()
    for r in got:
        want = cases[r.t]
        assert r.c.valid == (want is not None), r.t
        assert (r.c.name, r.c.size, r.c.price) == (want or (None, None, None)), r.t


def test_hstore_text(spark):
    cases = {
        "": {}, '"a"=>"b"': {"a": "b"}, "a=>b, c => NULL": {"a": "b", "c": None}, r'"q\"x"=>"y\\z"': {'q"x': "y\\z"}, '"n"=>"NULL"': {"n": "NULL"},
        '"a"=>"b""c"=>"d"': None, '"a"=>"b",': None, "junk": None, '"a"=>': None, '"a,b"=>"c=>d", "a,b"=>"last"': {"a,b": "last"},
    }
    for r in texts(spark, list(cases)).select("t", PG.hstore_decode("t").alias("m")).collect():
        assert r.m == cases[r.t], r.t


def test_offsets_with_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12), 330, 0), (dt.datetime(2024, 1, 1, 12), -90, -15), (dt.datetime(2024, 1, 1, 12), 0, 20)], "t timestamp_ntz, m int, s int")
    got = df.select(PG.offset_label("m", "s").alias("l"), PG.offset_to_utc("t", "m", "s").alias("u")).collect()
    assert [r.l for r in got] == ["+05:30", "-01:30:15", "+00:00:20"]
    assert [r.u for r in got] == [dt.datetime(2024, 1, 1, 6, 30), dt.datetime(2024, 1, 1, 13, 30, 15), dt.datetime(2024, 1, 1, 11, 59, 40)]


def test_update_takes_one_whole_row_and_sets_null(spark):
    target = spark.createDataFrame([(1, 0, 0), (2, 5, 5), (3, 7, 7)], "k int, a int, b int")
    updates = spark.createDataFrame([(1, 1, 9), (1, 5, 2), (2, None, 8), (9, 1, 1)], "k int, a int, b int")
    got = sorted(tuple(r) for r in R.update_from_rows(target, updates, ["k"], ["a", "b"]).collect())
    assert got == [(1, 1, 9), (2, None, 8), (3, 7, 7)]


def test_null_keys_never_conflict(spark):
    target = spark.createDataFrame([("x", 1)], "k string, v int")
    rows = spark.createDataFrame([(None, 2, 1), (None, 3, 2), ("x", 4, 3), ("y", 6, 5), ("y", 5, 4)], "k string, v int, at int")
    got = sorted(map(str, FL.insert_ignore(target, rows, ["k"], "at").collect()))
    assert got == sorted(["Row(k='x', v=1)", "Row(k=None, v=2)", "Row(k=None, v=3)", "Row(k='y', v=5)"])


def test_header_csv_goes_by_name(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("store,card_number,timestamp,customer_name,total_price,cash_or_card,basket_items,extra\n")
        f.write("Leeds,123,01-02-2024 09:00:00,Ann,2.5,CASH,Tea - 2.5,z\n")
    r = C.read_header_csv(spark, f"{tmp_dir}/a.csv").first()
    assert (r.timestamp, r.store, r.card_number, r.total_price) == ("01-02-2024 09:00:00", "Leeds", "123", 2.5)
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("store,timestamp\nLeeds,x\n")
    with pytest.raises(ValueError, match="card_number"):
        C.read_header_csv(spark, f"{tmp_dir}/b.csv")


def test_item_csv_keeps_quotes_and_edge_spaces(spark, tmp_dir):
    rows = [(1, 'Tea "hot", big', "1.30", " Mint"), (2, "Latte ", "2.00", ""), (3, "a\\b", "3.00", 'say ""')]
    df = spark.createDataFrame(rows, "transaction_id long, product_name string, price string, flavour_name string")
    df = df.withColumn("price", F.col("price").cast("decimal(10,2)"))
    C.write_items_csv(df, f"{tmp_dir}/items")
    got = C.read_items_csv(spark, f"{tmp_dir}/items").orderBy("transaction_id").collect()
    assert [(r.transaction_id, r[1], str(r[2]), r.flavour) for r in got] == rows


def test_line_breaks_in_quotes(spark, tmp_dir):
    with open(f"{tmp_dir}/raw.csv", "w") as f:
        f.write('01-02-2024 09:00:00,Leeds,Ann,"Tea - 1.30,\nCake - 2.00",3.30,CARD,123\n')
    df = C.read_raw_csv(spark, f"{tmp_dir}/raw.csv", multi_line=True)
    assert df.count() == 1 and "\n" in df.first().products


CARDS = ["4444000011112222", "5555000011113333"]


def test_quarantine_holds_no_card_number_or_name(spark, tmp_dir):
    line = ["01-02-2024 09:01:00", "Leeds", "Ann Ode", '"Tea - 1.30"', "1.30", "CARD", CARDS[0]]
    lines = [",".join(line)]
    lines += [",".join(line[:n] + line[n + 1 :]) for n in range(7)]  # a field missing anywhere
    lines += [",".join(line[:n] + ["surplus"] + line[n:]) for n in range(7)]
    lines += [",".join(line[2:]), ",".join([CARDS[1], "Ann Ode", "Leeds", '"Tea - 1.30"', "1.30", CARDS[0], "CARD"])]
    lines += [",".join(["01-02-2024 09:01:00", CARDS[0], "x", '"Tea - 1.30"', CARDS[1] + "x", "Ann Ode", "CARD"])]
    with open(f"{tmp_dir}/raw.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    load_batch(wh, C.read_raw_csv(spark, f"{tmp_dir}/raw.csv"), 1, source="s")
    tables = ["stores", "customers", "products", "flavours", "transactions", "baskets", "quarantine"]
    held = [str(v) for t in tables for row in wh.read(t).collect() for v in row]
    assert wh.read("quarantine").count() >= 15
    assert not [v for v in held if any(c in v for c in CARDS) or "Ann Ode" in v]
    assert staging.KNOWN_PAYMENTS == ["CARD", "CASH"]


def test_clean_names(spark):
    assert [R.clean_name(n) for n in ("a b", "1x", "_y", "é-z", "", "a_b", "#")] == ["a_b", "f1x", "f_y", "é_z", "", "a_b", "f_"]


def _sales(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_two_loads_at_once_are_both_whole(spark, tmp_dir):
    """The second load waits for the first; ids and batches do not collide."""
    from concurrent.futures import ThreadPoolExecutor

    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    feeds = [
        _sales(f"{tmp_dir}/{n}/raw.csv", [f'0{d}-02-2024 09:00:00,{n},Cus {d},"Tea {n} - 1.30",1.30,CASH,' for d in range(1, 6)])
        for n in ("East", "West")
    ]
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda p: load_batch(wh, C.read_raw_csv(spark, p), source=p, once=True), feeds))
    assert sorted(r.batch_id for r in done) == [1, 2]
    assert sorted(r.transaction_id for r in wh.read("transactions").collect()) == list(range(1, 11))
    assert wh.read("baskets").count() == 10
    assert sorted((r.store_id, r.store_name) for r in wh.read("stores").collect()) in (
        [(1, "East"), (2, "West")], [(1, "West"), (2, "East")],
    )
    again = load_batch(wh, C.read_raw_csv(spark, feeds[0]), source=feeds[0], once=True)
    assert again.skipped and again.batch_id == done[0].batch_id
    assert not os.path.exists(f"{tmp_dir}/wh/_claim")


def test_claims_wait_fail_and_outlive_a_lost_driver(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    Warehouse(spark, root).bootstrap()
    with Claim(spark, root) as first:
        with pytest.raises(LoadInProgress):
            with Claim(spark, root, wait_s=0):
                pass
        first.check()
    with open(f"{root}/_claim", "w") as f:  # what a lost driver leaves
        f.write("lost")
    with Claim(spark, root, stale_s=0.5) as second:
        second.check()
        with open(f"{root}/_claim", "w") as f:
            f.write("taken")
        with pytest.raises(LoadInProgress):
            second.check()
    assert open(f"{root}/_claim").read() == "taken"  # only its own claim is released


def test_failed_load_drops_its_scratch(spark, tmp_dir):
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    feed = _sales(f"{tmp_dir}/in/raw.csv", ["short,row"])
    with pytest.raises(BadRowsError):
        load_batch(wh, C.read_raw_csv(spark, feed), 1, on_bad_row="fail")
    left = f"{tmp_dir}/wh/_scratch"
    assert not os.path.exists(left) or not os.listdir(left)
    assert not os.path.exists(f"{tmp_dir}/wh/_claim")
