"""Look-back windows across two time columns, by exact prefix sums.

For a probe at time t the rows whose fact time lies in [t - hours, t] are
the facts up to t less the facts up to t - hours - 1 microsecond.  So every
row gives one fact and two marks to a time line ordered by (keys, time), and
the answer is the difference of the running totals at its marks.  No fact is
copied and no pair is formed.

The line is range-partitioned by Spark on (keys, time, fact before mark, row
id): partitions hold about equally many rows whatever the times are, one key
or one instant with a third of all rows is spread over many of them, and a
stray date far from the others costs nothing.  Totals run inside a
partition and are shifted by one row per partition, the totals before it.
They run on over the keys, because only facts of a mark's own key lie between
it and its companion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.temporal import epoch_micros
from strata.session import reliable

HOUR_US = 3_600_000_000
_LINE = ["_k", "_t", "_mark", "_tie"]


def _from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))


def time_line(df: DataFrame, id_col: str, keys: list[str], probe_time: str, fact_time: str, value: Column,
              hours: float, partitions: int) -> DataFrame:
    """Rows (_k, _t, _mark, _tie, _sign, _id, keys, _v, _part), ranged by the
    first four: facts have _mark 0, the marks at a probe's time and just
    before its window have _mark 1 and _sign 1 and -1.  Kept in the
    checkpoint folder, so that totals and shifts come from one
    partitioning."""
    width = int(hours * HOUR_US)
    # one struct of the keys: nulls in it equal each other
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    probe, fact = epoch_micros(F.col(probe_time)), epoch_micros(F.col(fact_time))

    def event(t, mark, sign):
        return F.struct(t.alias("_t"), F.lit(mark).alias("_mark"), F.lit(sign).alias("_sign"), value.alias("_v"))
    events = F.array(event(fact, 0, 0), event(probe, 1, 1), event(probe - (width + 1), 1, -1))
    line = (df.select(F.col(id_col).alias("_id"), *keys, key.alias("_k"), F.explode(events).alias("_e"))
            .select("_id", *keys, "_k", "_e.*").where((F.col("_mark") == 1) | F.col("_t").isNotNull())
            .withColumn("_tie", F.xxhash64("_id", "_sign")))
    return reliable(line.repartitionByRange(partitions, *_LINE).withColumn("_part", F.spark_partition_id()))


def _marked_totals(line: DataFrame, keys: list[str], partitions: int, neighbours: bool) -> DataFrame:
    """Rows (_id, keys, _sign, s, n, rows, last, next) of the marks: the
    running totals up to them, and with ``neighbours`` the last fact up to
    them and the first one after."""
    is_fact = F.col("_mark") == 0
    fact = F.when(is_fact, F.col("_t"))
    rows = line.withColumn("_fact", fact).withColumn("_one", is_fact.cast("long")) \
        .withColumn("_s", F.when(is_fact, F.col("_v"))).withColumn("_n", (is_fact & F.col("_v").isNotNull()).cast("long"))
    order = [F.col(c) for c in _LINE]
    inside = Window.partitionBy("_part")
    up = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = inside.orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    # one partition per task, as they were cut
    dealt = rows.repartitionById(partitions, "_part")
    at = dealt.select("_id", *keys, "_part", "_mark", "_sign", F.sum("_s").over(up).alias("s"), F.sum("_n").over(up).alias("n"),
                      F.sum("_one").over(up).alias("rows"), *([
                          F.last("_fact", ignorenulls=True).over(up).alias("last"),
                          F.last("_fact", ignorenulls=True).over(down).alias("next")] if neighbours else []))
    # one row per partition: a proven bound, small enough for one task and for a broadcast
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.struct(*_LINE)
    whole = rows.groupBy("_part").agg(F.sum("_s").alias("s"), F.sum("_n").alias("n"), F.sum("_one").alias("rows"),
                                      F.max_by("_fact", F.when(is_fact, ends)).alias("hi"),
                                      F.min_by("_fact", F.when(is_fact, ends)).alias("lo"))
    shift = whole.select("_part", F.sum("s").over(before).alias("s0"), F.sum("n").over(before).alias("n0"),
                         F.sum("rows").over(before).alias("r0"), F.last("hi", ignorenulls=True).over(before).alias("last0"),
                         F.last("lo", ignorenulls=True).over(after).alias("next0"))
    zero = F.lit(0)
    return at.where("_mark = 1").join(F.broadcast(shift), "_part").select(
        "_id", *keys, "_sign", (F.coalesce("s", zero) + F.coalesce("s0", zero)).alias("s"),
        (F.col("n") + F.coalesce("n0", zero)).alias("n"), (F.col("rows") + F.coalesce("r0", zero)).alias("rows"),
        *([F.coalesce("last", "last0").alias("last"), F.coalesce("next", "next0").alias("next")] if neighbours else []))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rolling_lookback(df: DataFrame, id_col: str, probe_time: str, fact_time: str, value: str,
                     hours: float = 3.0, keys: list[str] | tuple = (), mean_col: str = "mean_value",
                     count_col: str = "n_in_window", decimal_scale: int = 6,
                     partitions: int | None = None) -> DataFrame:
    """For each row at ``probe_time`` t: mean and count of ``value`` over the
    rows whose ``fact_time`` lies in [t - hours, t] (inclusive), within equal
    ``keys`` (nulls equal).  An empty window gives a NULL mean and count 0, a
    row without probe time has an empty window, and ``id_col`` names a row.

    Values are rounded to ``decimal_scale`` decimals and summed exactly, so
    the mean, a decimal quotient rounded half-up, does not depend on the
    order of the rows.  ``partitions`` is the number of tasks, by default
    ``spark.sql.shuffle.partitions``.
    """
    keys = list(keys)
    amount = F.col(value).cast("double").cast(exact_type(decimal_scale))
    tasks = partitions or _tasks(df)
    both = _marked_totals(time_line(df, id_col, keys, probe_time, fact_time, amount, hours, tasks), keys, tasks,
                          neighbours=False)
    out = both.groupBy("_id", *keys).agg(F.sum(F.col("_sign") * F.col("n")).alias("_n"),
                                         F.sum(F.col("_sign") * F.col("s")).alias("_s"))
    return out.select(F.col("_id").alias(id_col), *keys, exact_mean(F.col("_s"), F.col("_n"), decimal_scale).alias(mean_col),
                      F.col("_n").alias(count_col))


def exact_type(decimal_scale: int) -> str:
    """Type in which values are summed."""
    return f"decimal(28,{decimal_scale})"


def exact_mean(total: Column, n: Column, decimal_scale: int) -> Column:
    """Decimal quotient, rounded half-up; NULL of nothing."""
    return F.when(n > 0, total.cast(exact_type(decimal_scale)) / n)


def lookback_events(df: DataFrame, id_col: str, probe_time: str, fact_time: str, hours: float = 3.0,
                    keys: list[str] | tuple = (), partitions: int | None = None) -> DataFrame:
    """For each row at ``probe_time`` t: how many rows of equal ``keys`` have
    their ``fact_time`` in [t - hours, t], and the first and last of these
    times (NULL if none): (id, keys, n_facts, first_fact, last_fact)."""
    keys = list(keys)
    tasks, none = partitions or _tasks(df), F.lit(None).cast("decimal(28,0)")
    both = _marked_totals(time_line(df, id_col, keys, probe_time, fact_time, none, hours, tasks), keys, tasks,
                          neighbours=True)
    out = both.groupBy("_id", *keys).agg(
        F.sum(F.col("_sign") * F.col("rows")).alias("n_facts"),
        F.max(F.when(F.col("_sign") == -1, F.col("next"))).alias("_first"),
        F.max(F.when(F.col("_sign") == 1, F.col("last"))).alias("_last"))
    some = F.col("n_facts") > 0
    return out.select(F.col("_id").alias(id_col), *keys, "n_facts",
                      F.when(some, _from_micros(F.col("_first"))).alias("first_fact"),
                      F.when(some, _from_micros(F.col("_last"))).alias("last_fact"))
