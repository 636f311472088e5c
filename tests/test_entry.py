"""The driver contract: entry() runs, every query has a callable, and Spark equals DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as se
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"

def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state", "total_orders", "unique_customers", "total_revenue", "avg_order_line_value",
                          "total_quantity_sold"]


def test_every_query_has_an_oracle():
    """The optional corpus queries have tests of their own."""
    optional = set(se.llm.QUERIES) if se.llm else set()
    q, sql = set(se.queries()), set(se.oracle_sql())
    assert sql <= q
    assert q - optional == sql - optional


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(set(se.oracle_sql())))
def test_query_matches_oracle(spark, duck, key):
    df = se.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(se.oracle_sql()[key])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)
