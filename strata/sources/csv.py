"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             rename: Callable[[str], str] | None = None, timestamp_ntz_format: str | None = None,
             timestamp_format: str | None = None, partitions: int | None = None) -> DataFrame:
    """Read CSV with a header.  Give ``schema`` in production (inference
    reads the data twice).  A gzip file is one unsplittable task, so
    ``partitions`` spreads the rows after the scan.  ``rename`` maps every
    column name (e.g. ``_`` -> ``-``)."""
    r = spark.read.option("header", header).option("mode", "FAILFAST")
    if timestamp_ntz_format:
        r = r.option("timestampNTZFormat", timestamp_ntz_format)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    if partitions:
        df = df.repartition(partitions)
    if rename:
        df = df.toDF(*[rename(c) for c in df.columns])
    return df


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None,
              timestamp_ntz_format: str | None = None, mode: str = "overwrite") -> str:
    """Write CSV part files (one per task) under ``path``."""
    w = df.write.mode(mode).option("header", header)
    if compression:
        w = w.option("compression", compression)
    if timestamp_ntz_format:
        w = w.option("timestampNTZFormat", timestamp_ntz_format)
    w.csv(path)
    return path
