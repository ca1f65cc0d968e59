"""Every registered query that has SQL gives the same rows as DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_entry_has_the_feature_columns(spark):
    assert len(entry.entry(spark).columns) == 28  # key, target and 26 features


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(SQL[name])
    want = cur.fetchall()
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, want) and got
