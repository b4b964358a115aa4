"""Counts, means, extents, histograms, box plots and multi-aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views
from strata.sources.tables import table

BINS = 100
BINS_2D = 50


def _hist_sql(value_sql: str, bins: int, src: str) -> str:
    return f"""
WITH src AS (SELECT CAST({value_sql} AS DOUBLE) AS v FROM {src}),
s AS (SELECT v FROM src WHERE v IS NOT NULL),
ext AS (SELECT min(v) AS lo, max(v) AS hi FROM s),
b AS (SELECT CAST(CASE WHEN hi - lo = 0 THEN 0
                  ELSE least(floor((v - lo) / (hi - lo) * {float(bins)}), {bins - 1}) END AS INTEGER) AS bin,
             lo, hi FROM s, ext)
SELECT bin, count(*) AS n, round(min(lo + bin * ((hi - lo) / {float(bins)})), 6) AS bin_start,
       round(min(lo + (bin + 1) * ((hi - lo) / {float(bins)})), 6) AS bin_end
FROM b GROUP BY bin"""


@query("histogram", _hist_sql("l_extendedprice", BINS, "lineitem"))
def histogram(spark, d):
    """100 equal-width bins of the item price."""
    return rounded(agg.histogram(views.goods(spark, d), "price", BINS))


@query("histogram_log1p", _hist_sql("ln(1 + l_extendedprice)", BINS, "lineitem"))
def histogram_log1p(spark, d):
    """100 bins of log(1 + price) (written as ln(1 + x) on both engines)."""
    g = views.goods(spark, d)
    return rounded(agg.histogram(g, F.ln(F.lit(1.0) + F.col("price")), BINS))


@query("histogram_2d", f"""
WITH s AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
e AS (SELECT min(x) xlo, max(x) xhi, min(y) ylo, max(y) yhi FROM s)
SELECT CAST(CASE WHEN xhi - xlo = 0 THEN 0 ELSE least(floor((x - xlo) / (xhi - xlo) * {float(BINS_2D)}), {BINS_2D - 1}) END AS INTEGER) AS bin_x,
       CAST(CASE WHEN yhi - ylo = 0 THEN 0 ELSE least(floor((y - ylo) / (yhi - ylo) * {float(BINS_2D)}), {BINS_2D - 1}) END AS INTEGER) AS bin_y,
       count(*) AS n
FROM s, e GROUP BY 1, 2""")
def histogram_2d(spark, d):
    """50 x 50 binned counts of quantity ("carat") against price."""
    return agg.histogram_2d(views.goods(spark, d), "carat", "price", BINS_2D)


@query("boxplot_stats", """
WITH s AS (SELECT l_returnflag AS clarity, l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
q AS (SELECT clarity, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM s GROUP BY clarity)
SELECT s.clarity, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))) AS n_outliers,
  count(*) AS n
FROM s JOIN q ON s.clarity = q.clarity GROUP BY s.clarity, q1, median, q3""")
def boxplot_stats(spark, d):
    """Price quartiles and whiskers per return flag ("clarity")."""
    return rounded(agg.boxplot_stats(views.goods(spark, d), ["clarity"], "price"))


@query("global_mean", with_views("SELECT round(avg(dur), 6) AS mean FROM trips", "trips"))
def global_mean(spark, d):
    return rounded(agg.global_mean(views.trips(spark, d), "dur"))


@query("mean_by_zone_hour", with_views("""
SELECT k, CAST(hour(pickup) AS INTEGER) AS hour, round(avg(dur), 6) AS mean_dur, count(*) AS n
FROM trips GROUP BY 1, 2""", "trips"))
def mean_by_zone_hour(spark, d):
    """Mean duration per (zone, pickup hour) - zone is the event type here."""
    t = views.trips(spark, d).withColumn("hour", F.hour("pickup"))
    return rounded(t.groupBy("k", "hour").agg(F.avg("dur").alias("mean_dur"),
                                              F.count(F.lit(1)).alias("n")))


@query("multi_agg", """
SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty,
  round(avg(l_extendedprice), 6) AS mean_price, min(l_discount) AS min_disc, max(l_discount) AS max_disc,
  round(avg(l_extendedprice * (1 - l_discount)), 6) AS mean_net
FROM lineitem GROUP BY l_returnflag""")
def multi_agg(spark, d):
    """Several aggregates of one group in a single pass (map-side partials)."""
    li = table(spark, d, "lineitem")
    return rounded(li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_extendedprice").alias("mean_price"), F.min("l_discount").alias("min_disc"),
        F.max("l_discount").alias("max_disc"),
        F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("mean_net")))


@query("axis_extents", with_views("""
SELECT 'lat' AS axis, round(min(v), 6) AS lo, round(max(v), 6) AS hi
FROM (SELECT plat AS v FROM geo UNION ALL SELECT dlat FROM geo)
UNION ALL
SELECT 'long', round(min(v), 6), round(max(v), 6) FROM (SELECT plong AS v FROM geo UNION ALL SELECT dlong FROM geo)""", "geo"))
def axis_extents(spark, d):
    """min/max over the union of pickup and dropoff coordinates, per axis."""
    g = views.geo(spark, d)
    lat = agg.extents((g, "plat"), (g, "dlat")).withColumn("axis", F.lit("lat"))
    lon = agg.extents((g, "plong"), (g, "dlong")).withColumn("axis", F.lit("long"))
    return rounded(lat.unionByName(lon).select("axis", "lo", "hi"))
