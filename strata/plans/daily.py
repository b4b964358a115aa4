"""Daily counts, weekday means, a weekday regression and its residuals.

One Catalyst plan computes the daily counts; the regression is a
``pyspark.ml`` fit on the (small) daily table; predictions and residuals
are column expressions on the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.temporal import DOW_NAMES
from strata.models.features import one_hot
from strata.models.learn import explain_linear, fit_ols, predict_linear
from strata.plans import views

BASE_DAY = "Mon"
DUMMIES = [f"day_of_week-{d}" for d in DOW_NAMES if d != BASE_DAY]


def dow_means(spark: SparkSession, d: str) -> DataFrame:
    return views.daily_with_dow(spark, d).groupBy("day_of_week", "dow") \
        .agg(F.avg("n").alias("mean_n"))


def weekday_onehot(spark: SparkSession, d: str) -> DataFrame:
    return one_hot(views.daily_with_dow(spark, d), "day_of_week", DOW_NAMES, drop_source=False)


def weekday_model(spark: SparkSession, d: str):
    data = weekday_onehot(spark, d).withColumn("n", F.col("n").cast("double"))
    return fit_ols(data, "n", DUMMIES)


def weekday_terms(spark: SparkSession, d: str) -> DataFrame:
    return explain_linear(spark, weekday_model(spark, d), DUMMIES)


def residuals(spark: SparkSession, d: str, model=None) -> DataFrame:
    """daily rows with predicted_n and residual = n - predicted_n."""
    model = model or weekday_model(spark, d)
    data = weekday_onehot(spark, d)
    pred = predict_linear(data, model, DUMMIES, out_col="predicted_n")
    return pred.select("date", "n", "day_of_week", "predicted_n",
                       (F.col("n") - F.col("predicted_n")).alias("residual"))


def bad_days(spark: SparkSession, d: str, threshold: float) -> DataFrame:
    return residuals(spark, d).filter(F.col("residual") < F.lit(threshold))
