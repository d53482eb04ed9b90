"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from scripts.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _keys():
    from __spark_entry__ import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _keys())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    sdf = queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["days_since_first_active", "pct_active", "n"]
    assert df.count() > 0
