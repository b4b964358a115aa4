"""Sorts, top-k, repeatable sampling, shuffles, splits and k-fold folds.

Row positions (row numbers, shuffle positions, folds) are computed
without a global single-partition window.  Rows are first cut into
ordered buckets, numbered inside each bucket, and shifted by the running
count of the buckets before them.  A bucket is a range partition of the
whole sort tuple, kept in the checkpoint folder, or the leading bits of a
uniform hash.  Only the per-bucket count table moves, and a key or value
holding a third of the rows is spread over many buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.hashing import hash_key, hash_unit
from strata.session import reliable


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def sort_by(df: DataFrame, *cols: str, descending: bool = False) -> DataFrame:
    """Sort with NULLs last in both directions."""
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in cols]
    return df.orderBy(*order)


def top_k(df: DataFrame, by: str, k: int, tie_break: str | None = None,
          descending: bool = True) -> DataFrame:
    """k rows with the largest (or smallest) ``by``; ties broken by key.

    Plans as TakeOrderedAndProject: each task keeps its own k best rows and
    only those k x tasks rows are merged.
    """
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    order = [first] + ([F.col(tie_break).asc()] if tie_break else [])
    return df.orderBy(*order).limit(k)


def head_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """First n rows by the row key (Spark rows have no intrinsic order)."""
    return df.orderBy(F.col(key).asc()).limit(n)


TAKE_ORDERED_MAX = 100_000


def sample_n(df: DataFrame, n: int, key: str, seed: int = 1, method: str = "md5") -> DataFrame:
    """Exactly min(n, rows) rows without replacement, same on any layout.

    Small n: TakeOrderedAndProject (each task keeps its n best hashes).
    Large n: seeded positions computed bucket-wise, then a filter, so the
    sample never passes through one task."""
    if n <= TAKE_ORDERED_MAX:
        return df.orderBy(hash_key(key, seed=seed, method=method), F.col(key)).limit(n)
    return shuffle_positions(df, key, seed=seed, col="_spos", method=method) \
        .filter(F.col("_spos") < n).drop("_spos")


def _num_buckets(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return int(buckets)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _order_spec(order) -> list[tuple[str, bool]]:
    """Normalise ``order``: names ascending, ``(name, "desc")`` descending."""
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, False))
        else:
            name, direction = o
            out.append((name, str(direction).lower() == "desc"))
    return out


def _order_cols(spec) -> list[Column]:
    return [F.col(n).desc() if desc else F.col(n).asc() for n, desc in spec]


_LOCAL = 33              # bits of a partition's row number in monotonically_increasing_id


def _ranged_positions(df: DataFrame, ordering: list[Column], group_cols: list[str], buckets: int) -> DataFrame:
    """Columns ``_g`` (position in (group, order) over the whole table),
    from Spark's own range partitioning of the whole sort tuple: rows are
    numbered where they are sorted, and shifted by the row counts of the
    partitions before.  The sorted rows are kept in the checkpoint folder,
    so that numbers and counts come from one and the same partitioning."""
    order = [F.col(g).asc() for g in group_cols] + ordering
    rows = reliable(df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_bkt", F.shiftright("_at", _LOCAL))
    counts = rows.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.select("_bkt", (F.sum("_cnt").over(Window.orderBy("_bkt")) - F.col("_cnt")).alias("_off"))
    # one row per partition: a proven bound, safe to broadcast
    return rows.join(F.broadcast(offs), "_bkt").withColumn(
        "_g", F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << _LOCAL) - 1))).drop("_at", "_bkt", "_off")


def positions(df: DataFrame, order: list, group_cols: list[str] | tuple = (),
              bucket: Column | None = None, buckets: int | None = None,
              pos_col: str = "pos", size_col: str | None = None) -> DataFrame:
    """Add the 0-based position of each row inside its group, in ``order``.

    ``order`` lists column names (ascending) or ``(name, "desc")`` pairs and
    must be a total order (end it with a unique key).  By default rows are
    range-partitioned on the whole order, so that a group, or one value,
    that holds a third of the rows is spread by its tie-break key.
    ``bucket`` is an optional integer column that never decreases along
    ``order`` within a group, such as the leading bits of a hash; rows are
    then numbered inside (group, bucket) and shifted by the row counts of
    the earlier buckets of their group.  Null group values form one group.
    """
    group_cols = list(group_cols)
    ordering = _order_cols(_order_spec(order))
    if bucket is None:
        rows = _ranged_positions(df, ordering, group_cols, _num_buckets(df, buckets))
        if not group_cols:
            out = rows.withColumnRenamed("_g", pos_col)
            return out.withColumn(size_col, rows.agg(F.count(F.lit(1))).scalar()) if size_col else out
        starts = rows.groupBy(*[F.col(g).alias(f"_s_{g}") for g in group_cols]).agg(
            F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_gsize"))
        out = rows.join(starts, [rows[g].eqNullSafe(starts[f"_s_{g}"]) for g in group_cols])
        out = out.withColumn(pos_col, F.col("_g") - F.col("_start"))
        if size_col:
            out = out.withColumn(size_col, F.col("_gsize"))
        return out.drop("_g", "_start", "_gsize", *[f"_s_{g}" for g in group_cols])
    df = df.withColumn("_bkt", bucket)
    local_w = Window.partitionBy(*group_cols, "_bkt").orderBy(*ordering)
    local = df.withColumn("_lpos", F.row_number().over(local_w) - 1)

    counts = df.groupBy(*group_cols, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    run_w = Window.partitionBy(*group_cols).orderBy("_bkt")
    offs = counts.select(
        *group_cols, "_bkt",
        (F.sum("_cnt").over(run_w) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias("_gsize"))
    if not group_cols:
        # one row per bucket: a proven bound, safe to broadcast
        offs = F.broadcast(offs)
    out = local.join(offs, on=[*group_cols, "_bkt"], how="inner") \
        .withColumn(pos_col, F.col("_lpos") + F.col("_off"))
    if size_col:
        out = out.withColumn(size_col, F.col("_gsize"))
    return out.drop("_bkt", "_lpos", "_off", "_cnt", "_gsize")


def row_numbers(df: DataFrame, key: str, col: str = "row_number", one_based: bool = True,
                buckets: int | None = None) -> DataFrame:
    """Row number in key order, computed bucket-wise (no single-task window)."""
    out = positions(df, [key], buckets=buckets, pos_col=col)
    return out.withColumn(col, F.col(col) + 1) if one_based else out


def shuffle_positions(df: DataFrame, key: str, seed: int = 1, col: str = "shuffle_pos",
                      buckets: int | None = None, method: str = "md5") -> DataFrame:
    """Seeded random permutation: ``col`` is each row's place in it."""
    nb = _num_buckets(df, buckets)
    bucket = F.floor(hash_unit(key, seed=seed, method=method) * nb).cast("int")
    hashed = df.withColumn("_hk", hash_key(key, seed=seed, method=method))
    out = positions(hashed, ["_hk", key], bucket=bucket, pos_col=col)
    return out.drop("_hk")


def train_test_split(df: DataFrame, key: str, train_fraction: float = 0.7, seed: int = 1,
                     col: str = "split", method: str = "md5") -> DataFrame:
    """Tag rows 'train' / 'test' by a hash of the key (layout independent)."""
    return df.withColumn(col, F.when(hash_unit(key, seed=seed, method=method) < F.lit(train_fraction),
                                     F.lit("train")).otherwise(F.lit("test")))


def split_frames(df: DataFrame, key: str, train_fraction: float = 0.7, seed: int = 1):
    tagged = train_test_split(df, key, train_fraction, seed, col="_split")
    return (tagged.filter(F.col("_split") == "train").drop("_split"),
            tagged.filter(F.col("_split") == "test").drop("_split"))


def kfold_assign(df: DataFrame, key: str, k: int = 5, seed: int = 1, col: str = "fold",
                 method: str = "md5") -> DataFrame:
    """Each row gets exactly one validation fold; fold sizes differ by <= 1."""
    out = shuffle_positions(df, key, seed=seed, col="_spos", method=method)
    return out.withColumn(col, (F.col("_spos") % k).cast("int")).drop("_spos")
