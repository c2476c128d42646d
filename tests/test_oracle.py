"""Every registered query against its DuckDB oracle."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "decimal(10,2)": "DECIMAL(10,2)",
}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
from tillstar.catalog import QUERIES  # noqa: E402  the library's own queries

NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("D", str(v))
    if isinstance(v, float):
        return ("F", round(v, 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("T", v.isoformat())
    return (type(v).__name__, v)


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: TYPE_NAMES.get(t, t) for c, t in stypes.items()} == dtypes
    assert len(srows) == len(drows)
    assert _key(df.columns, srows) == _key(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["transaction_id", "time_stamp", "store_id", "customer_id", "total_price",
                          "payment_type", "product_id", "flavour_id"]


@pytest.mark.parametrize("name", NAMES)
def test_plan_stays_in_the_jvm(spark, name):
    """No Python UDF evaluation and no cartesian product in any registered query."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "PythonUDF"):
        assert node not in plan, f"{name}: {node}"
