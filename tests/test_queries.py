"""Every query against the same question in DuckDB, on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from varzea.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{plain(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert got
        return
    result = duck.execute(SQL[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == columns
    assert got == sorted(tuple(plain(r[named.index(c)]) for c in columns) for r in result.fetchall())
