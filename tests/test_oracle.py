"""Every registered query gives what its SQL gives in DuckDB."""

import datetime
import decimal

import duckdb
import pytest

from tallyloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return float(f"{float(v):.9g}")
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df, rel = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    have = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=repr)
    assert have == want
