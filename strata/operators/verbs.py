"""Column verbs: select, drop, rename, add columns, shape, materialise."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the dataset: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename every column by a function of its name (``toDF`` keeps the plan)."""
    return df.toDF(*[fn(c) for c in df.columns])


def add_column(df: DataFrame, name: str, value: Column | Callable[[DataFrame], Column]) -> DataFrame:
    """Add or replace one column; ``value`` may be a function dataset -> column."""
    col = value(df) if callable(value) and not isinstance(value, Column) else value
    return df.withColumn(name, col)


def add_columns(df: DataFrame, cols: Mapping[str, Column | Callable[[DataFrame], Column]]) -> DataFrame:
    """Add several columns at once; every expression sees the *input* columns."""
    resolved = {k: (v(df) if callable(v) and not isinstance(v, Column) else v) for k, v in cols.items()}
    return df.withColumns(resolved)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def zip_by_position(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Attach ``right``'s columns to ``left`` row by row.

    Spark rows have no position, so "by position" means "by the shared
    row key"; callers number rows with ``ordering.row_numbers`` first when
    the key is a position.  A row without a counterpart (unequal lengths)
    is an error when the result is computed.
    """
    both = left.withColumn("_left", F.lit(True)).join(right.withColumn("_right", F.lit(True)), on=key, how="full")
    alone = F.col("_left").isNull() | F.col("_right").isNull()
    whole = both.filter(F.when(alone, F.raise_error(F.lit("columns of unequal length"))).otherwise(F.lit(True))
                        .cast("boolean"))
    return whole.drop("_left", "_right")


def shape(df: DataFrame) -> DataFrame:
    """One row: row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def materialise(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Pin a (lazily computed) DataFrame so later actions reuse it."""
    return df.persist(level)


def transform_chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a chain of dataset -> dataset steps (a reusable verb chain)."""
    for step in steps:
        df = df.transform(step)
    return df
