"""Daily counts -> weekday means -> weekday regression -> residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.temporal import DOW_NAMES
from strata.models.learn import predict_linear
from strata.operators.joins import left_join_keep_keys, lookup_join
from strata.plans import daily as flow
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views

# residual threshold for the "bad days" filter at the driver's scales
# (days hold a handful of orders, not the ~900 flights of the original)
BAD_DAY_THRESHOLD = -3.0


@query("daily_counts", with_views("SELECT date, n FROM daily", "daily"))
def daily_counts(spark, d):
    return views.daily(spark, d)


@query("dow_lookup", """
WITH names(dow, day_of_week) AS (VALUES (1,'Mon'),(2,'Tue'),(3,'Wed'),(4,'Thu'),(5,'Fri'),(6,'Sat'),(7,'Sun'))
SELECT d.date, d.n, CAST(isodow(d.date) AS INTEGER) AS dow, names.day_of_week
FROM (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1) d
JOIN names ON names.dow = isodow(d.date)""")
def dow_lookup(spark, d):
    """Weekday number of each day joined to an inline name table (7 rows,
    broadcast after its size check)."""
    names = spark.createDataFrame(list(enumerate(DOW_NAMES, start=1)), "dow int, day_of_week string")
    days = views.daily(spark, d).withColumn("dow", F.weekday("date") + 1)
    return lookup_join(days, names, on="dow").select("date", "n", "dow", "day_of_week")


@query("dow_means", with_views(
    "SELECT day_of_week, dow, round(avg(n), 6) AS mean_n FROM daily_with_dow GROUP BY 1, 2",
    "daily_with_dow"))
def dow_means(spark, d):
    return rounded(flow.dow_means(spark, d))


@query("one_hot", with_views(
    "SELECT date, n, " + ", ".join(
        f"CASE WHEN day_of_week = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"day_of_week-{v}\"" for v in DOW_NAMES)
    + " FROM daily_with_dow", "daily_with_dow"))
def one_hot_days(spark, d):
    return flow.weekday_onehot(spark, d).drop("day_of_week", "dow")


_MEANS = "(SELECT day_of_week, avg(n) AS m FROM daily_with_dow GROUP BY 1)"
_OLS_SQL = with_views(f"""
SELECT '(intercept)' AS term, round(m, 6) AS coefficient FROM {_MEANS} base WHERE day_of_week = 'Mon'
UNION ALL
SELECT 'day_of_week-' || a.day_of_week AS term, round(a.m - b.m, 6) AS coefficient
FROM {_MEANS} a JOIN {_MEANS} b ON b.day_of_week = 'Mon' AND a.day_of_week <> 'Mon'""", "daily_with_dow")


@query("ols_dow", _OLS_SQL)
def ols_dow(spark, d):
    """Least squares on six weekday dummies (Monday is the base level):
    intercept = Monday mean, coefficient = weekday mean - Monday mean."""
    return rounded(flow.weekday_terms(spark, d))


_RESID_SQL = with_views("""
SELECT date, n, d.day_of_week, round(m.mean_n, 6) AS predicted_n, round(n - m.mean_n, 6) AS residual
FROM daily_with_dow d JOIN (SELECT day_of_week, avg(n) AS mean_n FROM daily_with_dow GROUP BY 1) m
  ON d.day_of_week = m.day_of_week""", "daily_with_dow")


@query("residuals", _RESID_SQL)
def residuals(spark, d):
    return rounded(flow.residuals(spark, d))


@query("filter_mask", _RESID_SQL.replace("ON d.day_of_week = m.day_of_week",
                                         f"ON d.day_of_week = m.day_of_week WHERE n - m.mean_n < {BAD_DAY_THRESHOLD}"))
def filter_mask(spark, d):
    return rounded(flow.bad_days(spark, d, BAD_DAY_THRESHOLD))


@query("left_join", with_views("""
SELECT p.day_of_week, round(p.predicted_n, 6) AS predicted_n, m.day_of_week AS "right.day_of_week",
       round(m.mean_n, 6) AS mean_n
FROM (SELECT day_of_week, avg(n) AS predicted_n FROM daily_with_dow GROUP BY 1) p
LEFT JOIN (SELECT day_of_week, avg(n) AS mean_n FROM daily_with_dow GROUP BY 1) m
  ON p.day_of_week = m.day_of_week""", "daily_with_dow"))
def left_join(spark, d):
    """Model predictions for the seven weekday names, left-joined to the
    observed weekday means; both key columns are kept."""
    model = flow.weekday_model(spark, d)
    names = spark.createDataFrame([(n,) for n in DOW_NAMES], "day_of_week string")
    from strata.models.features import one_hot
    pred = predict_linear(one_hot(names, "day_of_week", DOW_NAMES, drop_source=False), model,
                          flow.DUMMIES, out_col="predicted_n").select("day_of_week", "predicted_n")
    means = flow.dow_means(spark, d).select("day_of_week", "mean_n")
    return rounded(left_join_keep_keys(pred, means, ["day_of_week"]))
