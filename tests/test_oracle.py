"""Every query with SQL must equal what DuckDB makes of it."""

import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(rows):
    def value(v):
        if isinstance(v, decimal.Decimal):
            return float(v)
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(r[k]) for k in sorted(r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(r.asDict() for r in got.collect()) == plain(dict(zip(want.columns, r, strict=True)) for r in want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
