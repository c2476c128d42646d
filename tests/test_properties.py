"""Property tests (hypothesis): each example is one Spark job over a generated frame."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.functions import pgtypes as PG
from tillstar.operators import keys as K

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys_st = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "", "zz"]), st.integers(-3, 3)), min_size=1, max_size=60)


@SETTINGS
@given(rows=keys_st, start=st.integers(0, 50))
def test_ordered_ids_match_row_number(spark, tmp_path_factory, rows, start):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, tag long")
    path = str(tmp_path_factory.mktemp("ids"))
    exp = {r.tag: r.e for r in df.select("tag", (F.row_number().over(Window.orderBy("k", "v", "tag")) + start).alias("e")).collect()}
    ranged = {r.tag: r.id for r in K.ordered_ids_ranged(df, ["k", "v"], "id", path, start=start, tiebreak=["tag"], num_partitions=3).collect()}
    assert ranged == exp


range_st = st.tuples(
    st.one_of(st.none(), st.integers(-1000, 1000)),
    st.one_of(st.none(), st.integers(-1000, 1000)),
    st.sampled_from(["[)", "(]", "()", "[]", None]),
)


def _is_range(lo, hi, bounds):
    return bounds is None or lo is None or hi is None or lo <= hi


@SETTINGS
@given(ranges=st.lists(range_st, min_size=1, max_size=40), x=st.integers(-1100, 1100))
def test_range_format_parse_round_trip_and_contains(spark, ranges, x):
    df = spark.createDataFrame([(i, lo, hi, b) for i, (lo, hi, b) in enumerate(ranges)], "i int, lo long, hi long, b string")
    r = df.select("i", PG.make_range("lo", "hi", F.col("b")).alias("r"))
    back = r.select("i", "r", PG.range_parse(PG.range_format("r"), "bigint").alias("p"), PG.range_contains("r", F.lit(x)).alias("c"))
    for row in back.collect():
        lo, hi, b = ranges[row.i]
        if not _is_range(lo, hi, b):  # reversed bounds: no range, no text
            assert row.r is None and not row.p.valid
            continue
        assert row.p.valid
        if b is None:
            assert row.p.bounds is None and row.c is False
            continue
        assert (row.p.lower, row.p.upper, row.p.bounds) == (lo, hi, b)
        ok = (lo is None or (x >= lo if b[0] == "[" else x > lo)) and (hi is None or (x <= hi if b[1] == "]" else x < hi))
        assert row.c == ok


text_st = st.text(alphabet=st.sampled_from(list('ab"\\,=> ')), max_size=6)


@SETTINGS
@given(pairs=st.dictionaries(text_st, st.one_of(st.none(), text_st), max_size=5))
def test_hstore_encode_decode_round_trip(spark, pairs):
    items = list(pairs.items())
    df = spark.createDataFrame([(items,)], "m array<struct<k:string,v:string>>")
    m = F.map_from_entries(F.transform("m", lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value"))))
    out = df.select(PG.hstore_decode(PG.hstore_encode(m)).alias("d")).first().d
    assert (out or {}) == pairs
