"""Equi and lookup joins (time-range lookups are in ``windows``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def left_join_keep_keys(left: DataFrame, right: DataFrame, keys: list[str],
                        right_prefix: str = "right.") -> DataFrame:
    """Left outer equi-join that keeps both key columns; the right one is
    renamed ``right.<key>`` (other clashing right columns get the prefix too)."""
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.`{k}`") == F.col(f"_r.`{k}`")
        cond = c if cond is None else cond & c
    out_cols = [F.col(f"_l.`{c}`").alias(c) for c in left.columns]
    for c in right.columns:
        name = f"{right_prefix}{c}" if (c in keys or c in left.columns) else c
        out_cols.append(F.col(f"_r.`{c}`").alias(name))
    return l.join(r, cond, "left").select(*out_cols)


def lookup_join(facts: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact table to a dimension.  The planner broadcasts the
    dimension when its file or run-time size is below
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are
    shuffled and AQE splits skewed keys."""
    return facts.join(dim, on=on, how=how)
