"""Query registry: name -> Spark builder, plus its DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from strata.session import require_utc

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
ROUND = 6


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, data_dir) -> DataFrame`` under ``name``; ``sql`` is
    its DuckDB oracle (omitted for trained models and file round trips)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, data_dir):
            require_utc(spark)
            return fn(spark, data_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = ROUND) -> DataFrame:
    """Round every floating or decimal column (results are compared across
    engines); decimals are rounded half-up exactly, then shown as double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), places)
        elif isinstance(f.dataType, DecimalType):
            c = F.round(c, places).cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_mean_half_up(total_cents: str, n: str, places: int = ROUND) -> str:
    """DuckDB: mean of a non-negative 2-decimal total, rounded half-up to
    ``places`` decimals in integer arithmetic (as Spark's exact decimal
    division), returned as DOUBLE; NULL when n = 0."""
    scale = 10 ** (places - 2)
    return (f"CASE WHEN ({n}) > 0 THEN CAST((CAST(({total_cents}) * 100 AS HUGEINT) * {2 * scale} + ({n}))"
            f" // (2 * ({n})) AS DOUBLE) / {float(10 ** places)} END")


def sql_round(expr: str, places: int = ROUND) -> str:
    """DuckDB rounding close to Spark's ``round`` on doubles.

    Spark rounds the double's exact binary value half-up; DuckDB's
    ``round`` scales by 10^places first and can land on the other side of
    a tie (65.9503125 -> 65.950312 where Spark gives 65.950313).  Going
    through the shortest text form and a DECIMAL agrees with Spark except
    for doubles just below an exact decimal tie; where such ties are
    possible (means of 2-decimal values) the queries use exact decimals
    and ``sql_mean_half_up`` instead.
    """
    return (f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 12)), {places}) AS DOUBLE)")
