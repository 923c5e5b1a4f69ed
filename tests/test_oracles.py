"""Every registered query against its SQL twin in DuckDB on the small tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from ledgerflow.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None).map(lambda v: round(v, 6) if isinstance(v, float) else v)
    return sorted(map(str, df.values.tolist()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert len(got) > 0
