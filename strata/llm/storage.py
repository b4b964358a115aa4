"""Cutting lineage in the shared checkpoint folder, row filters and samples
that keep texts where they are, and bit arrays filled by tasks."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import reliable


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a reliable checkpoint, so that its
    users neither compute it again nor lose it with an executor."""
    return reliable(df)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files, and with ``cleanCheckpoints`` the
    checkpoints, of frames that nothing refers to any more.  It does so when
    the driver's garbage is collected, which a small driver seldom needs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own ``scratch_path`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


BROADCAST_IDS = 1 << 20  # ids of at most this many rows are sent to every task


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128 bits that stand for a row's id and text; null is not empty."""
    def part(c):
        return F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    return F.md5(F.concat(part(id_col), F.lit("\0"), part(text_col)))


def semi(docs: DataFrame, ids: DataFrame, column: str | Column, keep: bool) -> DataFrame:
    """Rows of ``docs`` whose ``column`` is (``keep``) or is not among the
    one column of ``ids``; null equals null.  The ids are counted first:
    up to ``BROADCAST_IDS`` they are broadcast and the texts stay where
    they are, beyond that both sides are shuffled."""
    ids = cut(ids.toDF("__id").distinct())
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    mine = F.col(f"`{column}`") if isinstance(column, str) else column
    return docs.join(ids, mine.eqNullSafe(F.col("__id")), "left_semi" if keep else "left_anti")


def hashed_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """All rows if there are at most ``n``; else those whose hash of
    ``columns`` falls below the share that leaves about 0.95 n of them, so
    that more than ``n`` are left only if most rows share a hash.  The same
    rows on any layout, and no row passes through the driver."""
    total = df.count()
    if total <= n:
        return df
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(0.95 * n / total * (1 << 40)))


_PARTS = 5               # log2 of the tasks that fill a bit array


def bit_array(ids: DataFrame, bits: int) -> np.ndarray:
    """2^``bits`` bits (bit i in byte i >> 3), set at the leading bits of the
    one column of 64-bit ``ids``.  It is filled by 2^_PARTS tasks, and only
    their parts, 2^(bits - 3) bytes in all, reach the driver."""
    def fill(batches):
        part, flags = None, None
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            if len(at) and flags is None:
                part, flags = int(at[0]) >> (bits - _PARTS), np.zeros(1 << (bits - _PARTS), np.uint8)
            if len(at):
                flags[at & np.uint64((1 << (bits - _PARTS)) - 1)] = 1
        if flags is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()])})
    part = F.shiftrightunsigned("__id", 64 - _PARTS).cast("int")
    parts = ids.toDF("__id").repartitionById(1 << _PARTS, part).mapInArrow(fill, "part int, bits binary").collect()
    out, size = np.zeros(1 << (bits - 3), np.uint8), 1 << (bits - 3 - _PARTS)
    for r in parts:
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def has_bit(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``ids`` have their bit set."""
    at = ids >> np.uint64(64 - (len(table).bit_length() + 2))
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
