"""The operators that SQL can express, against DuckDB on the small tables."""

from __future__ import annotations

import duckdb
import pytest

from ledgerflow.llm.queries import ORACLE_SQL, QUERIES
from tests.test_oracles import TABLES, plain


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_operator_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)
