"""Every registered query of the directory engine against its SQL, on the smallest tables."""

import datetime
import decimal
import math
import os
from glob import glob

import duckdb
import pytest

from dirbook.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return "None" if isinstance(value, float) and math.isnan(value) else f"{round(float(value), 5) + 0.0:.5f}"
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([plain(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    found = QUERIES[name](spark, SF)
    got = table(found.columns, found.collect())
    if name in ORACLES:
        want = oracle.execute(ORACLES[name])
        assert got == table([c[0] for c in want.description], want.fetchall())
