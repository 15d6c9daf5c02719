"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tidemark.plans import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return int(v) if v == int(v) else float(f"{v:.9g}")
    return int(v) if hasattr(v, "__index__") else str(v).removesuffix(" 00:00:00")


def rows(df):
    columns = sorted(df.columns)
    return sorted(tuple(repr(plain(v)) for v in r) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
