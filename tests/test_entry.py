"""Driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as E
from strata.plans import catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["date", "n", "day_of_week", "predicted_n", "residual"]
    days = spark.read.parquet(f"{E.SMOKE_DIR}/orders.parquet").selectExpr("cast(o_orderdate as date) as d").distinct().count()
    assert 0 < len(rows) < days
    assert all(r["residual"] < 0 for r in rows)


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) <= set(q) and len(catalog.QUERIES) >= 100


def test_no_reserved_names():
    for name in catalog.QUERIES:
        assert not name.startswith("op") and "pipeline" not in name
