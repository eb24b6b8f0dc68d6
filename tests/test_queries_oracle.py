"""Every registered query with an SQL twin must equal DuckDB's result (rows, columns and an
order-insensitive hash of the values) on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_a_builder_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0 and "o_totalprice_mean" in df.columns
