"""Rolling look-back mean over a stream of trips.

For every trip picked up at t: mean and count of the durations of trips
of the same key dropped off in [t - hours, t].  As a stream this is an
event-time stream-stream LEFT OUTER join (probes = pickups, facts =
dropoffs) with the time-range condition, followed by an aggregation per
probe.  Watermarks on both sides bound the join state to the look-back
span plus the allowed lateness; the aggregation emits each probe once
its pickup time passes the watermark (append mode).  Values are summed
exactly, and the mean has the type and rounding of the batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import exact_mean, exact_type


def rolling_lookback_stream(trips: DataFrame, id_col: str, key: str, probe_time: str, fact_time: str,
                            value: str, hours: int = 3, lateness: str = "1 hour",
                            mean_col: str = "mean_value", count_col: str = "n_in_window",
                            decimal_scale: int = 6) -> DataFrame:
    """``trips`` is a streaming DataFrame; returns a streaming DataFrame of
    (id, key, probe_time, mean, count) in append mode."""
    probes = trips.select(F.col(id_col).alias("p_id"), F.col(key).alias("p_key"),
                          F.col(probe_time).alias("p_time")).withWatermark("p_time", lateness)
    facts = trips.select(F.col(key).alias("f_key"), F.col(fact_time).alias("f_time"),
                         F.col(value).cast("double").cast(exact_type(decimal_scale)).alias("f_value")).withWatermark("f_time", lateness)
    cond = ((F.col("f_key") == F.col("p_key"))
            & (F.col("f_time") >= F.col("p_time") - F.expr(f"INTERVAL {int(hours)} HOURS"))
            & (F.col("f_time") <= F.col("p_time")))
    pairs = probes.join(facts, cond, "leftOuter")
    out = pairs.groupBy("p_id", "p_key", "p_time").agg(F.sum("f_value").alias("_s"), F.count("f_value").alias("_n"))
    return out.select(F.col("p_id").alias(id_col), F.col("p_key").alias(key), F.col("p_time").alias(probe_time),
                      exact_mean(F.col("_s"), F.col("_n"), decimal_scale).alias(mean_col), F.col("_n").alias(count_col))
