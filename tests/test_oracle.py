"""Every query with SQL against DuckDB on the smallest data."""

import math
import os

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans.catalogue import CORE

DATA = "/root/testdata/sf0.001"


def canonical(df):
    def one(x):
        if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
            return "null"
        if "float" in type(x).__name__:
            return f"{float(x):.9g}"
        return str(pd.Timestamp(x)) if hasattr(x, "isoformat") else str(x)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")
@pytest.mark.parametrize("name", sorted(CORE.oracles))
def test_query(spark, duck, name):
    got, want = CORE.queries[name](spark, DATA).toPandas(), duck.execute(CORE.oracles[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
