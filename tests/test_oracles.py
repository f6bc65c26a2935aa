"""Every query of the library itself against its DuckDB oracle (sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from nestflow.plans.oracles import ORACLES
from nestflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())


_FAMILY = {"string": "str", "varchar": "str", "int": "i32", "integer": "i32", "bigint": "i64",
           "double": "f64", "boolean": "bool", "timestamp_ntz": "ts", "timestamp": "ts", "date": "date"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    mine = {f.name: _FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    res = con.execute(f"SELECT * FROM ({ORACLES[name]}) LIMIT 0")
    theirs = {d[0]: _FAMILY.get(str(d[1]).lower(), str(d[1]).lower()) for d in res.description}
    assert mine == theirs


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["o_custkey", "o_orderkey", "o_orderdate", "create_time", "type"]
    assert df.count() > 0
