"""Label declaration, category indexing and one-hot columns."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_hot(df: DataFrame, col: str, values: list, drop_source: bool = True,
            sep: str = "-") -> DataFrame:
    """One 0.0/1.0 column per listed value, named ``<col><sep><value>``.

    The vocabulary is given, not discovered, so train and test frames get
    the same columns even when a value is missing from one of them.
    """
    out = df.withColumns({f"{col}{sep}{v}": F.when(F.col(col) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))
                          for v in values})
    return out.drop(col) if drop_source else out


def one_hot_range(df: DataFrame, col: str, n: int, drop_source: bool = True, sep: str = "-") -> DataFrame:
    """One-hot over the fixed vocabulary 0 .. n-1 (e.g. cluster ids)."""
    return one_hot(df, col, list(range(n)), drop_source=drop_source, sep=sep)


MAX_LABELS = 1_000_000   # distinct labels that a fitted indexer holds on the driver


def label_index(df: DataFrame, col: str, out_col: str = "label_idx") -> DataFrame:
    """Category -> number in alphabetical order (``StringIndexer`` alphabetAsc).

    Fits a ``StringIndexer`` (a distributed distinct, collected as the label
    list, at most ``MAX_LABELS`` by a check) and applies it.
    """
    if df.select(col).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"{col} has more than {MAX_LABELS} distinct labels")
    model = StringIndexer(inputCol=col, outputCol=out_col, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out_col, F.col(out_col).cast("int"))


def assemble(df: DataFrame, inputs: list[str], out_col: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=inputs, outputCol=out_col, handleInvalid="keep").transform(df)
