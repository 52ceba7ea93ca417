"""The correctness gate inside pytest: every registered query against its DuckDB oracle on
the smallest driver tables (row count, column names and types, order-insensitive values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    yield con
    con.close()


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_equals_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SMOKE)
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = duck.sql(E.oracle_sql()[key])
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert s_types == d_types
    cols = sorted(s_types)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    want = sorted(tuple(norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want
