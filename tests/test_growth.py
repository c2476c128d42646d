"""What must not grow with the data: broadcasts of the feed, sorts of the flat frame, readings of a replayed feed, the cost of a pair."""

from datetime import datetime

import pytest

from tillstar import catalog
from tillstar.functions import pgtypes as PG
from tillstar.operators import flat as FL
from tillstar.operators.range_join import range_join
from tillstar.sources.feed import local_feed, sales_feed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_dir):
    rows = {
        "nation": ([(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string"),
        "customer": ([(1, "ann", 2), (2, "bob", 3)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": (
            [(1, "ring", "LARGE", 1, 2.5), (2, "bolt", "SMALL", 3, 1.25)],
            "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
        ),
        "orders": (
            [(k, 1 + k % 2, 10.0 * k, datetime(2024, 1, k)) for k in (4, 9, 11, 12)],
            "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": (
            [(k, p, 3 - p, 1.0 * p) for k in (4, 9, 11, 12) for p in (1, 2)],
            "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.mode("overwrite").parquet(f"{tmp_dir}/tables/{name}.parquet")
    return f"{tmp_dir}/tables"


def test_the_feed_broadcasts_no_growing_table(spark, tables):
    feed = sales_feed(spark, tables)
    assert plan(feed).count("BroadcastHashJoin") <= 1  # nations
    baskets = {r.o_orderkey: r.products for r in feed.collect()}
    assert baskets == {k: "bolt - 1.25, ring - LARGE - 2.50" for k in (4, 9, 11, 12)}


def test_flat_tables_sort_no_rows_before_they_are_reduced(spark, tables, tmp_dir):
    flat = FL.flat_frame(local_feed(sales_feed(spark, tables)), f"{tmp_dir}/flat", keep_order=True)
    customers, flavours = FL.customers_table(flat), FL.flavours_table(flat)
    assert "SortAggregate" not in plan(customers) and "SortAggregate" not in plan(flavours)
    assert sorted(map(tuple, customers.collect())) == [(0, "ann"), (1, "bob")]
    prices = {r.product_name: str(r.price) for r in FL.products_table(flat).collect()}
    assert prices == {"ring ": "2.50", "bolt ": "1.25"}


def test_customers_are_numbered_on_sales_not_on_items(spark, tables, tmp_dir):
    sales, _ = FL.numbered_sales(local_feed(sales_feed(spark, tables)), f"{tmp_dir}/sales")
    assert sales.count() == 4


def test_a_replayed_feed_is_derived_once(spark, tables, monkeypatch):
    read, load = [], catalog.load_batch

    def spy(wh, raw, *args, **kw):
        read.extend(raw.inputFiles())
        return load(wh, raw, *args, **kw)

    monkeypatch.setattr(catalog, "load_batch", spy)
    assert catalog.q_replay_is_idempotent(spark, tables).count() == 8
    assert read and not any("lineitem.parquet" in f for f in read)


def test_a_pair_of_a_range_join_reads_no_bounds_text(spark):
    facts = spark.range(50).selectExpr("id", "id / 4 as x")
    texts = ["[1,2)", "(1,2]", "[3,3]", "(,2)", "[11,)", "empty", "(0.25,12.25)"]
    ranges = spark.createDataFrame([(t,) for t in texts], "t string")
    ranges = ranges.select("t", PG.range_parse("t", "decimal(10,2)").alias("range"))
    joined = range_join(facts, "x", ranges, pieces=8)
    assert "substring" not in plan(joined).split("SortMergeJoin")[1].split("\n")[0]
    want = facts.crossJoin(ranges).where(PG.range_contains("range", "x")).select("id", "t")
    assert sorted(map(tuple, joined.select("id", "t").collect())) == sorted(map(tuple, want.collect()))
