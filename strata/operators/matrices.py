"""Vectors and matrices as DataFrames.

A vector is an ``array<double>`` column (one row per vector) or long
form ``(c, x)``; a matrix is long form ``(r, c, v)``.  A matrix by a vector
is a join on the shared index plus a grouped sum.  A matrix by a matrix is
blocked: the operands are cut into row and column tiles, tiles meet on the
block of the inner index, and a row of A times a column of B is one array
expression inside the JVM.  Whether a small operand is broadcast is left to
the planner, which knows its size at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_vector(df: DataFrame, id_col: str, vec_col: str, pos: str = "pos",
                   value: str = "value") -> DataFrame:
    return df.select(id_col, F.posexplode(vec_col).alias(pos, value))


def matrix_vector(m: DataFrame, x: DataFrame) -> DataFrame:
    """y = M x with M as (r, c, v) and x as (c, x)."""
    return m.join(x, "c").groupBy("r").agg(F.sum(F.col("v") * F.col("x")).alias("y"))


BLOCK = 32               # inner indices, and columns of B, of a tile


def _block_of(index: str, block: int):
    return F.expr(f"(`{index}` - pmod(`{index}`, {block}L)) div {block}L")


def _strips(m: DataFrame, line: str, inner: str, block: int, *tile: str) -> DataFrame:
    """(tile, line, _kb, _x): the entries of each ``line`` (a row of A, a
    column of B) within a block of the inner index, as an array of ``block``
    values with NULL where there is no entry.  Entries given twice are
    added, as a sum of their products would."""
    at = F.pmod(F.col(inner), F.lit(block)).cast("int")
    keyed = m.where(F.col("v").isNotNull()).select(*tile, line, _block_of(inner, block).alias("_kb"),
                                                   at.alias("_at"), F.col("v").cast("double").alias("v"))
    keyed = keyed.repartition(*(tile or (line,)), "_kb")
    once = keyed.groupBy(*tile, line, "_kb", "_at").agg(F.sum("v").alias("v"))
    some = F.map_from_entries(F.collect_list(F.struct("_at", "v")))
    return once.groupBy(*tile, line, "_kb").agg(some.alias("_m")).select(*tile, line, "_kb", F.transform(
        F.sequence(F.lit(0), F.lit(block - 1)), lambda i: F.try_element_at(F.col("_m"), i)).alias("_x"))


def _dot(a, b):
    """Sum of the products of two arrays; NULL if no place has both."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(None).cast("double"),
                       lambda t, x: F.coalesce(t + x, t, x))


def matrix_multiply(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """C = A B with A and B as (r, c, v); indices are any longs, and an
    entry that sums to zero stays.  A NULL value is no entry.

    B's tiles hold ``block`` x ``block`` entries, A's are strips of one row.
    A strip that meets a tile gives one array of partial sums, so the rows
    joined and shuffled are a ``block``-th of the products (a ``block``
    squared-th before the columns are spread).  An inner block that holds
    much of A is a skewed join partition, which AQE splits.
    """
    left = _strips(a, "r", "c", block)
    right = _strips(b.select(F.col("r").alias("_k"), F.col("c").alias("_c"), "v",
                             _block_of("c", block).alias("_cb")), "_c", "_k", block, "_cb")
    tiles = right.groupBy("_cb", "_kb").agg(F.collect_list(F.struct("_c", F.col("_x").alias("x"))).alias("_columns"))
    products = left.join(tiles, "_kb").select("r", F.explode(F.transform(
        "_columns", lambda y: F.struct(y["_c"].alias("c"), _dot(F.col("_x"), y["x"]).alias("v")))).alias("p"))
    return products.select("r", "p.c", "p.v").where("v is not null").groupBy("r", "c").agg(F.sum("v").alias("v"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("c").alias("r"), F.col("r").alias("c"), "v")


def from_flat(df: DataFrame, id_col: str, vec_col: str, n_rows: int, n_cols: int,
              layout: str = "row") -> DataFrame:
    """Reshape each flat vector into an n_rows x n_cols matrix, row- or
    column-major: (id, r, c, v)."""
    ex = df.select(id_col, F.posexplode(vec_col).alias("_p", "v"))
    if layout == "row":
        r, c = (F.col("_p") / n_cols).cast("int"), (F.col("_p") % n_cols).cast("int")
    else:
        r, c = (F.col("_p") % n_rows).cast("int"), (F.col("_p") / n_rows).cast("int")
    return ex.select(id_col, r.alias("r"), c.alias("c"), "v")


def rotation(theta: float) -> list[list[float]]:
    return [[math.cos(theta), -math.sin(theta)], [math.sin(theta), math.cos(theta)]]


def rescale_y(s: float) -> list[list[float]]:
    return [[1.0, 0.0], [0.0, float(s)]]


def compose(m2: list[list[float]], m1: list[list[float]]) -> list[list[float]]:
    """m2 . m1 (apply m1 first)."""
    return [[sum(m2[i][k] * m1[k][j] for k in range(2)) for j in range(2)] for i in range(2)]


def apply_2x2(df: DataFrame, m: list[list[float]], x: str, y: str, out_x: str, out_y: str) -> DataFrame:
    """Apply a small literal matrix to every (x, y) row as column arithmetic."""
    return df.withColumns({
        out_x: F.lit(m[0][0]) * F.col(x) + F.lit(m[0][1]) * F.col(y),
        out_y: F.lit(m[1][0]) * F.col(x) + F.lit(m[1][1]) * F.col(y)})
