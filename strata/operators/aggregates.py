"""Group counts and means, frequencies, histograms, box-plot summaries and
error metrics.  All are map-side combinable aggregates, the exact quantiles
too: they are selected by counts over ever narrower ranges of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import reliable


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: list[str], value: str, name: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def frequencies(df: DataFrame, cols: list[str], name: str = "times") -> DataFrame:
    """Count of every distinct tuple, most frequent first (ties by the tuple)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name)) \
        .orderBy(F.col(name).desc(), *[F.col(c).asc_nulls_last() for c in cols])


def global_mean(df: DataFrame, value: str, name: str = "mean") -> DataFrame:
    return df.agg(F.avg(value).alias(name))


def extents(*frames_and_cols) -> DataFrame:
    """min and max over the union of several (DataFrame, column) pairs."""
    parts = [df.select(_c(c).cast("double").alias("_v")) for df, c in frames_and_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))


def _bin_expr(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = hi - lo
    raw = F.floor((v - lo) / F.when(width == 0, F.lit(1.0)).otherwise(width) * F.lit(float(bins)))
    return F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, value, bins: int = 100, keys: list[str] | tuple = ()) -> DataFrame:
    """Fixed-count equal-width histogram over [min, max]; the maximum falls
    in the last bin, a constant column in bin 0.  The extent is a scalar
    subquery (one row, evaluated once), not a join."""
    v = _c(value).cast("double")
    src = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())
    ext = src.select(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    lo, hi = ext["lo"], ext["hi"]
    b = _bin_expr(F.col("_v"), lo, hi, bins)
    out = src.select(*keys, b.alias("bin"), lo.alias("_lo"), hi.alias("_hi"), "_v")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        F.first(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"))


def histogram_2d(df: DataFrame, x, y, bins: int = 50) -> DataFrame:
    """Counts over a bins x bins grid spanning both columns' extents."""
    src = df.select(_c(x).cast("double").alias("_x"), _c(y).cast("double").alias("_y")) \
        .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    ext = src.select(F.struct(F.min("_x").alias("xlo"), F.max("_x").alias("xhi"),
                              F.min("_y").alias("ylo"), F.max("_y").alias("yhi"))).scalar()
    xlo, xhi, ylo, yhi = ext["xlo"], ext["xhi"], ext["ylo"], ext["yhi"]
    return src.select(_bin_expr(F.col("_x"), xlo, xhi, bins).alias("bin_x"),
                      _bin_expr(F.col("_y"), ylo, yhi, bins).alias("bin_y")) \
        .groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))


BINS = 1 << 14           # parts of a range of values, per pass
RANGES_SENT = 1 << 17    # ranges sent to every task, at most


def _binary_place(v: Column) -> Column:
    """A whole number that never falls when ``v`` rises: sign and binary
    exponent, a few thousand values in all."""
    size = F.when(F.abs(v) == float("inf"), 2000).otherwise(F.floor(F.log2(F.abs(v)))).cast("int") + 1100
    return F.when(F.isnan(v), 9999).when(v == 0, 0).otherwise(F.when(v > 0, size).otherwise(-size))


def _inner_place(v: Column, lo: Column, hi: Column) -> Column:
    """Which of ``BINS`` parts of [lo, hi] holds ``v``; lo and hi differ in theirs."""
    return F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(BINS))), F.lit(BINS - 1)).cast("int")


def exact_quantiles(df: DataFrame, group_cols: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolation quantiles (``quantile_cont``) per group, a
    null group included: (groups, q0, q1, ...), of the values not NULL (NaN
    above all others).

    Selection by counts: the first pass counts each group's values per sign
    and binary exponent, which tells the range in which each wanted rank
    lies; further passes cut these ranges into ``BINS`` parts and count only
    the values inside them, until a range is one value.  A pass is a
    map-side combined count, so nothing is sorted or stored and a group that
    holds a third of the rows is no burden.  Doubles need at most four
    passes after the first, values with few decimals one or two.
    """
    src = df.select(F.struct(*group_cols).alias("_g") if group_cols else F.struct(F.lit(0).alias("all")).alias("_g"),
                    F.col(value).cast("double").alias("_v")).where("_v is not null")
    counted = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    def ranges(bins, within):
        """Ranges with the number of values before them in ``within``."""
        before = Window.partitionBy(*within).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        return bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    first = ranges(src.groupBy("_g", _binary_place(F.col("_v")).alias("_bin")).agg(*counted), ["_g"])
    first = first.withColumn("_size", F.sum("_n").over(Window.partitionBy("_g")))
    place = [(F.col("_size") - 1) * F.lit(float(q)) for q in probs]
    wanted = F.explode(F.array_distinct(F.concat(*[F.array(F.floor(h), F.ceil(h)) for h in place]))).alias("_rank")
    found = reliable(first.select("*", wanted).where((F.col("_rank") >= F.col("_before")) &
                                                     (F.col("_rank") < F.col("_before") + F.col("_n")))
                     .select("_g", "_size", "_rank", "_before", "_lo", "_hi"))
    while True:
        todo = found.where("_lo < _hi")
        spans = todo.select(F.col("_g").alias("_h"), F.col("_before").alias("_base"), F.col("_lo").alias("_a"),
                            F.col("_hi").alias("_b")).distinct()
        n = spans.count()
        if not n:
            break
        spans = F.broadcast(spans) if n <= RANGES_SENT else spans
        inside = src.join(spans, (F.col("_g") == F.col("_h")) & F.col("_v").between(F.col("_a"), F.col("_b")))
        bins = inside.groupBy("_g", "_base", _inner_place(F.col("_v"), F.col("_a"), F.col("_b")).alias("_bin")).agg(*counted)
        bins = ranges(bins, ["_g", "_base"]).select(F.col("_g").alias("_h"), "_base", F.col("_n").alias("_m"),
                                                    F.col("_before").alias("_more"), F.col("_lo").alias("_a"), F.col("_hi").alias("_b"))
        rank = F.col("_rank") - F.col("_before") - F.col("_more")
        closer = (todo.join(bins, (F.col("_g") == F.col("_h")) & (F.col("_before") == F.col("_base")))
                  .where((rank >= 0) & (rank < F.col("_m")))
                  .select("_g", "_size", "_rank", (F.col("_before") + F.col("_more")).alias("_before"),
                          F.col("_a").alias("_lo"), F.col("_b").alias("_hi")))
        found = reliable(found.where("not (_lo < _hi)").unionByName(closer))
    ranks = F.map_from_entries(F.collect_list(F.struct("_rank", "_lo")))
    out = found.groupBy("_g").agg(F.first("_size").alias("_size"), ranks.alias("_at"))

    def between(h):
        low, high = F.element_at("_at", F.floor(h)), F.element_at("_at", F.ceil(h))
        return F.when(low == high, low).otherwise(low + (h - F.floor(h)) * (high - low))
    return out.select(*[F.col(f"_g.`{c}`").alias(c) for c in group_cols],
                      *[between(h).alias(f"q{i}") for i, h in enumerate(place)])


def boxplot_stats(df: DataFrame, group_cols: list[str], value: str, whisker: float = 1.5, exact: bool = True,
                  accuracy: int = 10_000) -> DataFrame:
    """Box-plot summary: quartiles, whiskers (extreme values within
    ``whisker`` x IQR of the box), outlier count and group size.

    ``exact=False`` takes the quartiles from ``percentile_approx`` sketches
    (one pass, merged map-side, rank error about 1/accuracy) instead of
    selecting them exactly."""
    if exact:
        q = exact_quantiles(df, group_cols, value, [0.25, 0.5, 0.75])
    else:
        q = df.where(F.col(value).isNotNull()).groupBy(*group_cols).agg(
            F.percentile_approx(F.col(value).cast("double"), [0.25, 0.5, 0.75], accuracy).alias("_q")) \
            .select(*group_cols, *[F.col("_q")[i].alias(f"q{i}") for i in range(3)])
    # nulls among the groups equal each other
    q = reliable(q.select(F.struct(*group_cols).alias("_h"), F.col("q0").alias("q1"), F.col("q1").alias("median"),
                          F.col("q2").alias("q3")))
    src = df.select(F.struct(*group_cols).alias("_g"), F.col(value).cast("double").alias("_v")).where("_v is not null")
    few = q.limit(RANGES_SENT + 1).count() <= RANGES_SENT
    joined = src.join(F.broadcast(q) if few else q, F.col("_g") == F.col("_h"))
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("_v").between(F.col("q1") - F.lit(whisker) * iqr, F.col("q3") + F.lit(whisker) * iqr)
    return joined.groupBy("_g", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
        F.count(F.lit(1)).alias("n")).select(*[F.col(f"_g.`{c}`").alias(c) for c in group_cols], "q1", "median", "q3",
                                             "whisker_lo", "whisker_hi", "n_outliers", "n")


def mae(df: DataFrame, predicted: str, actual: str, name: str = "mae") -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias(name))


def accuracy(df: DataFrame, predicted: str, actual: str, name: str = "accuracy") -> DataFrame:
    return df.agg(F.avg((F.col(predicted) == F.col(actual)).cast("double")).alias(name))


def metric_summary(scores: DataFrame, by: list[str], metric: str) -> DataFrame:
    """min / mean / max of a metric over folds, per setting."""
    return scores.groupBy(*by).agg(F.min(metric).alias("min"), F.avg(metric).alias("mean"),
                                   F.max(metric).alias("max"))


def best_fold(scores: DataFrame, by: list[str], metric: str, fold: str = "fold",
              higher_is_better: bool = True) -> DataFrame:
    """Per setting, only the best fold (ties -> lowest fold number)."""
    m = F.col(metric) if higher_is_better else -F.col(metric)
    best = F.max_by(F.struct(F.col(fold).alias("f"), F.col(metric).alias("m")),
                    F.struct(m, -F.col(fold)))
    return scores.groupBy(*by).agg(best.alias("_b")).select(
        *by, F.col("_b.f").alias(fold), F.col("_b.m").alias(metric))
