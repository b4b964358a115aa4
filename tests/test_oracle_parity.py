"""Every query with an oracle SQL gives the same rows in Spark and DuckDB
(on the smallest driver tables; the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import close, rows_of
from strata.sources.tables import TABLES

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    assert len(a) == len(b)
    bad = [(x, y) for x, y in zip(a, b) if not all(close(p, q) for p, q in zip(x, y))]
    assert not bad, bad[:3]
