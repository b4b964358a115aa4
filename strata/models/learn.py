"""Model fitting, prediction, explanation and evaluation on pyspark.ml.

Fits are distributed ``pyspark.ml`` jobs over all rows; only fitted state
(coefficients, centres, trees) lives on the driver, and it is bounded by
the number of features / clusters / nodes, not by the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.models.features import assemble


def fit_ols(df: DataFrame, label: str, features: list[str]) -> LinearRegressionModel:
    """Ordinary least squares (normal equations, no regularisation)."""
    data = assemble(df, features, "_features")
    lr = LinearRegression(featuresCol="_features", labelCol=label, predictionCol="_pred",
                          solver="normal", regParam=0.0, elasticNetParam=0.0, standardization=False)
    return lr.fit(data)


def explain_linear(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """Intercept and named coefficients as a (term, coefficient) table."""
    rows = [("(intercept)", float(model.intercept))]
    rows += [(name, float(c)) for name, c in zip(features, model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, coefficient double")


def predict_linear(df: DataFrame, model, features: list[str], out_col: str = "predicted") -> DataFrame:
    """Add the model's prediction as a column (keeps all input columns)."""
    data = assemble(df, features, "_features")
    return model.transform(data).withColumnRenamed("_pred", out_col).drop("_features")


def fit_gbt(df: DataFrame, label: str, features: list[str], max_iter: int = 20, seed: int = 1,
            max_depth: int = 5, step: float = 0.1):
    data = assemble(df, features, "_features")
    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="_pred",
                       maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed)
    return gbt.fit(data)


def predict_model(df: DataFrame, model, features: list[str], out_col: str = "predicted") -> DataFrame:
    data = assemble(df, features, "_features")
    return model.transform(data).withColumnRenamed("_pred", out_col).drop("_features")


def mean_model_fit(train: DataFrame, label: str, decimal_scale: int | None = None):
    """The baseline model: the training mean, as a one-row DataFrame.

    With ``decimal_scale`` the sum is exact (decimal), so the mean does not
    depend on the order partial sums are combined in."""
    if decimal_scale is None:
        return train.agg(F.avg(label).alias("_mean"))
    total = F.sum(F.col(label).cast(f"decimal(38,{decimal_scale})")).cast("double")
    return train.agg(F.try_divide(total, F.count(label)).alias("_mean"))


def mean_model_predict(df: DataFrame, fitted: DataFrame, out_col: str = "predicted") -> DataFrame:
    """Apply the mean model: a scalar subquery, not a join."""
    return df.withColumn(out_col, fitted.select("_mean").scalar())


def save_and_load_linear(model, path: str) -> LinearRegressionModel:
    """Write a fitted linear model to (shared) storage and read it back."""
    model.write().overwrite().save(path)
    return LinearRegressionModel.load(path)


def gram_by_group(df: DataFrame, label: str, features: list[str], group: str) -> dict:
    """Per group (n, X'X, X'y, y'y) of an intercept and the features, from
    one scan: a map-side combined row of sums per group.  Rows with a NULL
    label or feature are left out."""
    cols = [F.lit(1.0)] + [F.col(f"`{c}`").cast("double") for c in features] + [F.col(label).cast("double")]
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    whole = F.lit(True)
    for c in cols[1:]:
        whole = whole & c.isNotNull()
    sums = df.where(whole).groupBy(group).agg(*[F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in sums:
        m = np.zeros((d, d))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r[group]] = (m[0, 0], m[:-1, :-1], m[:-1, -1], m[-1, -1])
    return out


def cross_validated_ols(spark: SparkSession, df: DataFrame, label: str, features: list[str], fold: str) -> DataFrame:
    """Least squares on all folds but one, scored on that one: (fold,
    n_train, n_valid, rmse, r2, term, coefficient), a row per term.

    Gram matrices add up, so each fold's fit comes from the total less the
    fold's own, and its squared error from its own: one scan for all fits
    and scores.  A feature that is constant in training gets the least-norm
    coefficient.  Only the folds' matrices reach the driver.
    """
    grams = gram_by_group(df, label, features, fold)
    total = [sum(g[i] for g in grams.values()) for i in range(4)]
    rows = []
    for f, own in sorted(grams.items()):
        n, xx, xy, _ = (t - o for t, o in zip(total, own))
        if not n:
            continue
        b = np.linalg.lstsq(xx, xy, rcond=1e-12)[0]
        error = max(own[3] - 2 * b @ own[2] + b @ own[1] @ b, 0.0)
        spread = own[3] - own[2][0] ** 2 / own[0]
        r2 = float(1 - error / spread) if spread > 0 else None
        for name, c in zip(["(intercept)", *features], b):
            rows.append((f, int(n), int(own[0]), float(np.sqrt(error / own[0])), r2, name, float(c)))
    return spark.createDataFrame(rows, f"{fold} int, n_train long, n_valid long, rmse double, r2 double, "
                                       "term string, coefficient double")
