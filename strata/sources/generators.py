"""Generated data: index columns, shape grids and Gaussian clusters.

All generators start from ``spark.range`` or from key columns of a real
table, so the work is split over tasks; randomness is hashed from keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import hash_normal, hash_unit


def index_column(spark: SparkSession, n: int, fn: Callable[[Column], Column], name: str,
                 partitions: int | None = None) -> DataFrame:
    """Rows 0..n-1 with ``name`` = fn(idx)."""
    r = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return r.select(F.col("id"), fn(F.col("id")).cast("bigint").alias(name))


def grid(spark: SparkSession, shape: list[int], fn: Callable[..., Column], name: str = "value") -> DataFrame:
    """Every index tuple of ``shape`` (row-major) with value fn(i, j, k...).

    Indices are decoded from one ``range`` id by div/mod: no cross join.
    """
    total = 1
    for s in shape:
        total *= s
    idx = []
    stride = total
    for s in shape:
        stride //= s
        idx.append(((F.col("id") / stride).cast("long") % s).cast("int"))
    names = ["i", "j", "k", "l", "m"][:len(shape)]
    cols = [c.alias(n) for c, n in zip(idx, names)]
    r = spark.range(total).select(*cols)
    return r.withColumn(name, fn(*[F.col(n) for n in names]).cast("int"))


def gaussian_clusters(keys: DataFrame, key: str, centres: list[tuple[float, float]], seed: int = 1,
                      sd: float = 1.0) -> DataFrame:
    """One point per key: class = key mod len(centres), position = centre +
    sd x standard normal noise hashed from (key, seed); ``shuffle_key`` is a
    uniform hash for a seeded shuffle of the rows."""
    n = len(centres)
    cls = (F.col(key) % n).cast("int")
    cx = F.element_at(F.array(*[F.lit(float(c[0])) for c in centres]), cls + 1)
    cy = F.element_at(F.array(*[F.lit(float(c[1])) for c in centres]), cls + 1)
    return keys.select(
        F.col(key), cls.alias("cls"),
        (cx + F.lit(sd) * hash_normal(key, seed=seed)).alias("x"),
        (cy + F.lit(sd) * hash_normal(key, seed=seed + 1)).alias("y"),
        hash_unit(key, seed=seed + 2).alias("shuffle_key"))
