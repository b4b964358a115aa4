"""Generated columns and tables whose size follows the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.sources import generators as gen
from strata.plans.registry import query, rounded, sql_round
from strata.sources.tables import table

# The eight cluster centres of the synthetic classification set.
CENTRES = [(-5, 20), (3, 9), (0, 11), (4, 19), (2, -16), (4, 13), (-3, 2), (-6, 6)]


def _unit_sql(key_sql: str, seed: int) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{seed}'), 1, 13)) AS BIGINT)"
            f" / 4503599627370496.0)")


def _normal_sql(key_sql: str, seed: int) -> str:
    return (f"(sqrt(-2.0 * ln(1.0 - {_unit_sql(key_sql, seed)})) * "
            f"cos({2.0 * 3.141592653589793!r} * {_unit_sql(key_sql, seed + 7919)}))")


_CX = "CASE cls " + " ".join(f"WHEN {i} THEN {float(c[0])!r}" for i, c in enumerate(CENTRES)) + " END"
_CY = "CASE cls " + " ".join(f"WHEN {i} THEN {float(c[1])!r}" for i, c in enumerate(CENTRES)) + " END"


@query("gen_clusters", f"""
SELECT c_custkey AS id, cls,
  {sql_round(_CX + " + " + _normal_sql('c_custkey', 11))} AS x,
  {sql_round(_CY + " + " + _normal_sql('c_custkey', 12))} AS y,
  {sql_round(_unit_sql('c_custkey', 13))} AS shuffle_key
FROM (SELECT c_custkey, CAST(c_custkey % 8 AS INTEGER) AS cls FROM customer)""")
def gen_clusters(spark, d):
    """One Gaussian point (sd 1) per customer around one of 8 centres; the
    noise is a hash of the key, so it is the same on any layout."""
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return rounded(gen.gaussian_clusters(keys, "id", CENTRES, seed=11))


@query("gen_index", "SELECT CAST(id AS BIGINT) AS id, CAST(id * id AS BIGINT) AS sq "
                    "FROM range((SELECT count(*) FROM orders)) t(id)")
def gen_index(spark, d):
    """Index column of the orders' length and f(idx) = idx^2."""
    n = table(spark, d, "orders").count()
    return gen.index_column(spark, n, lambda i: i * i, "sq")


@query("gen_grid", """
SELECT CAST(id // (b * c) AS INTEGER) AS i, CAST((id // c) % b AS INTEGER) AS j, CAST(id % c AS INTEGER) AS k,
       CAST(id // (b * c) + 10 * ((id // c) % b) + 100 * (id % c) AS INTEGER) AS value
FROM (SELECT (SELECT count(*) FROM customer) AS a, (SELECT count(*) FROM region) AS b, 3 AS c) s,
     range((SELECT count(*) FROM customer) * (SELECT count(*) FROM region) * 3) t(id)""")
def gen_grid(spark, d):
    """Tensor of shape [customers, regions, 3] with value i + 10 j + 100 k."""
    a = table(spark, d, "customer").count()
    b = table(spark, d, "region").count()
    return gen.grid(spark, [a, b, 3], lambda i, j, k: i + 10 * j + 100 * k)
