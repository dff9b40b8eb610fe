"""Every registered query of the library proper against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from ledgerlark.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows(pdf):
    return sorted(tuple(map(cell, r)) for r in pdf[sorted(pdf.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got.columns)
        return
    want = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
