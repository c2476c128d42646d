"""Operators against brute force / hand-derived expectations."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tillstar.functions import pgtypes as PG
from tillstar.operators import keys as K
from tillstar.operators import rows as R
from tillstar.operators.range_join import range_join


# ---- ordered ids ------------------------------------------------------------

def _skewed(spark, n=3000):
    # a third of the rows share one key; the rest are spread out
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 1000).alias("v"),
        F.col("id").alias("tag"),
    )
    return df


def _brute(df, order, start=0):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("bid", F.row_number().over(w) + start)


def test_ranged_ids_equal_global_row_number(spark, tmp_dir):
    df = _skewed(spark)
    got = K.ordered_ids_ranged(df, ["k", "v"], "id", f"{tmp_dir}/r", start=100, tiebreak=["tag"])
    exp = _brute(df, ["k", "v", "tag"], start=100)
    a = {(r.tag, r.id) for r in got.select("tag", "id").collect()}
    b = {(r.tag, r.bid) for r in exp.select("tag", "bid").collect()}
    assert a == b
    assert sorted(i for _, i in a) == list(range(101, 101 + df.count()))


def test_ranged_ids_spread_hot_key(spark, tmp_dir):
    df = _skewed(spark, 6000)
    K.ordered_ids_ranged(df, ["k"], "id", f"{tmp_dir}/r", tiebreak=["tag"], num_partitions=8)
    ranged = spark.read.parquet(f"{tmp_dir}/r")
    sizes = [r[1] for r in ranged.groupBy(F.shiftright("_rid", 33)).count().collect()]
    # the hot key (2,000 rows) is split over several partitions, none holds it all
    assert max(sizes) < 2000


def test_ids_of_names_with_one_shared_prefix(spark, tmp_dir):
    """Names that agree in their first bytes spread over many range partitions."""
    df = spark.range(4000).select(F.concat(F.lit("Large part "), F.md5(F.col("id").cast("string"))).alias("name"))
    got = K.ordered_ids_ranged(df, ["name"], "id", f"{tmp_dir}/r", start=7, num_partitions=8)
    exp = _brute(df, ["name"], start=7)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in exp.collect()}
    sizes = [r[1] for r in spark.read.parquet(f"{tmp_dir}/r").groupBy(F.shiftright("_rid", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_group_numbers_null_is_minus_one(spark, tmp_dir):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string")
    got = K.group_numbers(df, "k", "g", path=f"{tmp_dir}/g")
    assert sorted((r.k or "", r.g) for r in got.collect()) == [("", -1), ("a", 0), ("b", 1), ("b", 1)]


# ---- range join -------------------------------------------------------------

def _nested_loop(facts, ranges):
    """Brute force: (fact id, range id) of every value inside a range."""
    inside = []
    for i, v in facts:
        for n, text, lo, hi, b in ranges:
            if v is None or b is None:
                continue
            low = lo is None or v > lo or (v == lo and b[0] == "[")
            high = hi is None or v < hi or (v == hi and b[1] == "]")
            if low and high:
                inside.append((i, n))
    return sorted(inside)


def test_range_join_equals_brute_force(spark):
    import random

    rng = random.Random(11)
    ranges = []
    for n in range(1200):
        lo = rng.choice([float(rng.randint(0, 5000)), rng.randint(0, 5000) + 0.5, -3.25])
        hi = lo + rng.choice([0.0, 1, 1, 1, 0.125, 7, 64, 1e6])
        if n % 100 == 0:
            lo = None
        if n % 75 == 0:
            hi = None
        ranges.append((n, "r", lo, hi, rng.choice(["[)", "[]", "()", "(]"]) if n % 90 else None))
    facts = [(i, rng.choice([float(rng.randint(-5, 5100)), rng.random() * 5000])) for i in range(400)]
    facts += [(900, 4e9), (901, -4e9), (902, None), (903, 0.0)]
    f = spark.createDataFrame(facts, "fid long, value double")
    r = spark.createDataFrame(ranges, "rid long, text string, lo double, hi double, b string").selectExpr(
        "rid", "named_struct('lower', lo, 'upper', hi, 'bounds', b) as range"
    )
    got = sorted((x.fid, x.rid) for x in range_join(f, "value", r).select("fid", "rid").collect())
    assert got == _nested_loop(facts, ranges)
    assert range_join(f.limit(0), "value", r).count() == 0
    assert range_join(f, "value", r.limit(0)).columns == ["fid", "value", "rid", "range"]


def test_range_join_of_any_number_is_an_equi_join(spark):
    f = spark.range(100).selectExpr("id as value")
    r = spark.range(3).selectExpr("id", "named_struct('lower', id, 'upper', cast(null as long), 'bounds', '[)') as range")
    plan = range_join(f, "value", r)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


RANGE = "named_struct('lower', lo, 'upper', hi, 'bounds', b) as range"


def _both_ways(spark, facts, ranges, pieces=None):
    """Joined (fact id, range id) by the operator and by a nested loop over the containment test."""
    got = sorted(map(tuple, range_join(facts, "value", ranges, pieces=pieces).select("fid", "rid").collect()))
    loop = facts.crossJoin(ranges).where(PG.range_contains("range", "value"))
    return got, sorted(map(tuple, loop.select("fid", "rid").collect()))


def test_range_join_with_nan_infinity_and_hot_values(spark):
    import random

    rng = random.Random(12)
    values = [rng.random() * 100 for _ in range(300)] + [50.0] * 400 + [float("nan")] * 5
    values += [float("inf"), float("-inf"), -0.0, 0.0, None, 5e-324, 1.7e308]
    f = spark.createDataFrame(list(enumerate(values)), "fid long, value double")
    ends = [None, 4.0, 50.0, float("inf"), float("-inf"), float("nan"), 0.0]
    rows = [(lo, hi, b) for lo in ends for hi in ends for b in ("[)", "(]", "()", "[]")]
    rows += [(x, x + rng.choice([0.0, 0.5, 9.0]), "[]") for x in (rng.random() * 100 for _ in range(300))] + [(1.0, 2.0, None), (9.0, 3.0, "[]")]
    r = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "rid long, lo double, hi double, b string").selectExpr("rid", RANGE)
    for pieces in (None, 1, 7, 64):
        got, want = _both_ways(spark, f, r, pieces)
        assert got == want and len(got) > 1000


def test_range_join_on_other_types(spark):
    base = "select id as fid, {} as value from range(500) union all select 900, null"
    ends = "select id as rid, {0} as lo, {1} as hi, element_at(array('[)', '(]', '()', '[]'), cast(id % 4 as int) + 1) as b from range({2})"
    cases = [
        ("date_add(date'2024-01-01', cast(id % 90 as int))", "date_add(date'2024-01-01', cast(id % 95 as int))", "date_add(date'2024-01-04', cast(id % 95 as int))"),
        ("timestamp_ntz'2024-03-31 01:00:00' + make_dt_interval(0, 0, cast(id as int))", "timestamp_ntz'2024-03-31 01:30:00' + make_dt_interval(0, cast(id as int))", "cast(null as timestamp_ntz)"),
        ("timestamp'2024-03-31 01:00:00' + make_dt_interval(0, 0, cast(id as int))", "cast(null as timestamp)", "timestamp'2024-03-31 01:30:00' + make_dt_interval(0, cast(id as int))"),
        ("9007199254740990 + id", "cast(9007199254740990 + id as double)", "cast(9007199254740999 + id as double)"),
        ("cast(id as decimal(20,3)) / 7", "cast(id % 70 as decimal(10,2))", "cast(id % 70 + 1 as decimal(10,2))"),
        ("cast(id % 3 as int)", "cast(0 as double)", "cast(id % 4 as double) / 2"),
    ]
    for value, lo, hi in cases:
        for n in (20, 300):
            f, r = spark.sql(base.format(value)), spark.sql(ends.format(lo, hi, n)).selectExpr("rid", RANGE)
            got, want = _both_ways(spark, f, r)
            assert got == want and got, value


def test_range_join_moves_facts_once(spark):
    f = spark.range(1000).selectExpr("id as value")
    r = spark.range(600).selectExpr("id as rid", "named_struct('lower', id, 'upper', cast(null as long), 'bounds', '[)') as range")
    plan = range_join(f, "value", r)._jdf.queryExecution().executedPlan().toString()
    facts = plan.split("SortMergeJoin")[1].split("Range (0, 1000")[0]
    assert "Generate" not in facts and facts.count("Exchange") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_on_text_is_refused(spark):
    import pytest

    with pytest.raises(TypeError):
        range_join(spark.sql("select 'a' as value"), "value", spark.sql("select named_struct('lower', 'a', 'upper', 'b', 'bounds', '[]') as range"))


def test_range_parse_edge_cases(spark):
    texts = ['["a""b","c\\\\d")', "(,)", "empty", "[1,2", "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", PG.range_parse("t", "string").alias("r"))
    got = {r.t: (r.r.lower, r.r.upper, r.r.bounds, r.r.valid) for r in df.collect()}
    assert got['["a""b","c\\\\d")'] == ('a"b', "c\\d", "[)", True)
    assert got["(,)"] == (None, None, "()", True)
    assert got["empty"] == (None, None, None, True)
    assert got["[1,2"][3] is False and got["garbage"][3] is False
    assert got[None][3] is False


def test_range_accessors_and_contains(spark):
    df = spark.createDataFrame([("[1,3)",), ("(1,3]",), ("[1,)",), ("empty",)], "t string").select(
        "t", PG.range_parse("t").alias("r"))
    out = df.select(
        "t", PG.range_lower_inc("r").alias("li"), PG.range_upper_inc("r").alias("ui"), PG.range_upper_inf("r").alias("uinf"),
        PG.range_contains("r", F.lit(1)).alias("c1"), PG.range_contains("r", F.lit(3)).alias("c3"),
    )
    got = {r.t: (r.li, r.ui, r.uinf, r.c1, r.c3) for r in out.collect()}
    assert got["[1,3)"] == (True, False, False, True, False)
    assert got["(1,3]"] == (False, True, False, False, True)
    assert got["[1,)"] == (True, False, True, True, True)
    assert got["empty"] == (False, False, False, False, False)


def test_range_equality_is_structural(spark):
    df = spark.createDataFrame([("[1,3)", "[1,2]"), ("[1,3)", "[1,3)"), ("empty", "empty")], "a string, b string")
    out = df.select(PG.range_equal(PG.range_parse("a"), PG.range_parse("b")).alias("eq"))
    assert [r.eq for r in out.collect()] == [False, True, True]


def test_hstore_decode_edge_cases(spark):
    texts = ['"a"=>"1", "b"=>NULL', '"k\\"q"=>"v\\\\w"', '"a"=>"1", "a"=>"2"', '"a"=>"1" junk', ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", PG.hstore_decode("t").alias("m"))
    got = {r.t: r.m for r in df.collect()}
    assert got['"a"=>"1", "b"=>NULL'] == {"a": "1", "b": None}
    assert got['"k\\"q"=>"v\\\\w"'] == {'k"q': "v\\w"}
    assert got['"a"=>"1", "a"=>"2"'] == {"a": "2"}
    assert got['"a"=>"1" junk'] is None
    assert got[""] == {}


def test_hstore_round_trip(spark):
    df = spark.createDataFrame([('"x"=>"a\\"b", "y"=>NULL',)], "t string")
    enc = df.select(PG.hstore_encode(PG.hstore_decode("t")).alias("e")).first().e
    assert enc == '"x"=>"a\\"b", "y"=>NULL'


def test_composite_edge_cases(spark):
    fields = [("a", "string"), ("b", "string"), ("c", "int"), ("d", "decimal(10,2)")]
    df = spark.createDataFrame([('(a,"b, ""c""",,9.00)',), ('("x")',)], "t string")
    out = df.select("t", PG.composite_decode("t", fields).alias("v")).collect()
    good = out[0].v
    assert (good.a, good.b, good.c, good.d, good.valid) == ("a", 'b, "c"', None, Decimal("9.00"), True)
    assert out[1].v.valid is False and out[1].v.a is None


def test_offset_labels(spark):
    df = spark.createDataFrame([(-90,), (330,), (0,), (-360,), (420,)], "m int")
    got = [r.l for r in df.select(PG.offset_label("m").alias("l")).collect()]
    assert got == ["-01:30", "+05:30", "+00", "-06", "+07"]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12, 0), 330)], "t timestamp_ntz, m int")
    assert ts.select(PG.offset_to_utc("t", "m").alias("u")).first().u == dt.datetime(2024, 1, 1, 6, 30)


def test_json_variant_and_typed(spark):
    df = spark.createDataFrame([('{"k": 5, "s": "x"}',), (None,), ("not json",)], "t string")
    out = df.select(
        PG.json_get(PG.json_decode("t"), "$.k", "int").alias("k"),
        PG.json_decode_typed("t", "k int, s string").alias("typed"),
    ).collect()
    assert [r.k for r in out] == [5, None, None]
    assert out[0].typed.s == "x"


# ---- row-list operators -------------------------------------------------------

def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["total price", "1st", "_x", "a-b", "ok_1"])
    assert R.clean_column_names(df).columns == ["total_price", "f1st", "f_x", "a_b", "ok_1"]
    with pytest.raises(ValueError):
        R.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_filter_in_long_list_uses_semi_join(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet")
    long = list(range(0, 3000, 2))
    a = R.filter_in(c, "c_custkey", long)
    b = c.where(F.col("c_custkey") % 2 == 0).where(F.col("c_custkey") < 3000)
    assert sorted(r.c_custkey for r in a.collect()) == sorted(r.c_custkey for r in b.collect())
    short = R.filter_in(c, "c_nationkey", [1, 3, 5])
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(c_nationkey" in plan


def test_update_from_rows(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k bigint, p double")
    u = spark.createDataFrame([(2, 20.0), (9, 90.0)], "k bigint, p double")
    got = sorted(tuple(r) for r in R.update_from_rows(t, u, ["k"], ["p"]).collect())
    assert got == [(1, 1.0), (2, 20.0), (3, 3.0)]
    assert R.insert_rows(t, [(4, 4.0)]).count() == 4


def test_group_numbers_same_with_and_without_broadcast(spark, tmp_dir, monkeypatch):
    df = spark.range(400).select(F.concat(F.lit("k"), (F.col("id") % 37).cast("string")).alias("k"))
    df = df.union(spark.createDataFrame([(None,)], "k string"))
    one = sorted((r.k or "", r.g) for r in K.group_numbers(df, "k", "g", f"{tmp_dir}/a").collect())
    monkeypatch.setattr(K, "BROADCAST_MAX_BYTES", 0)
    other = sorted((r.k or "", r.g) for r in K.group_numbers(df, "k", "g", f"{tmp_dir}/b").collect())
    assert one == other and one[0] == ("", -1) and one[-1][1] == 36


def test_group_maps_number_each_kind_from_zero(spark, tmp_dir):
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "y"), ("b", "x")], "k string, v string")
    got = K.group_maps(df, {"k": "k", "v": "v"}, f"{tmp_dir}/g").table
    assert {tuple(r) for r in got.collect()} == {
        ("k", None, -1), ("k", "a", 0), ("k", "b", 1), ("v", None, -1), ("v", "x", 0), ("v", "y", 1),
    }
    assert K.group_maps(df.limit(0), {"k": "k"}, f"{tmp_dir}/e").table.count() == 0


def test_broadcast_needs_a_proven_size_in_bytes(spark):
    from tillstar.operators.dims import fits_broadcast

    names = spark.createDataFrame([("a", 1)], "name string, id bigint")
    assert fits_broadcast(names, 1000) and not fits_broadcast(names, None)
    assert not fits_broadcast(names, 1_000_000)  # 255 bytes a name


def test_size_shuffle(spark, tmp_dir):
    from tillstar.session import TARGET_PARTITION_BYTES, path_bytes, size_shuffle

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        slots = spark.sparkContext.defaultParallelism
        assert size_shuffle(spark, 10) == 2 * slots
        assert size_shuffle(spark, 1000 * TARGET_PARTITION_BYTES) == max(2 * slots, 1000)
        assert path_bytes(spark, f"{SF_SMALL}/nation.parquet") > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
