"""The trip-duration model: trips with pickup coordinates clustered by
k-means fitted on the training split, one-hot cluster features plus trip
distance and time features, gradient-boosted regression, MAE on train
and test."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.models.flows import duration_flow, ensure_parallelism
from strata.operators.ordering import sample_n, train_test_split
from strata.session import reliable

LOC = ["plat", "plong"]
BASE = ["dist_km", "hour", "dow", "is_click", "is_view", "is_error"]


def taxi_trips(spark: SparkSession, d: str) -> DataFrame:
    """Trips with pickup coordinates (clustered by the flow), great-circle
    trip distance, pickup hour, ISO weekday and event-type flags; the
    label is the duration."""
    from strata.functions.geo import haversine
    from strata.plans.views import located_trips
    t = located_trips(spark, d)
    return t.select(
        "id", "plat", "plong",
        haversine("plat", "plong", "dlat", "dlong").alias("dist_km"),
        F.hour("pickup").cast("double").alias("hour"),
        (F.weekday("pickup") + 1).cast("double").alias("dow"),
        (F.col("k") == "click").cast("double").alias("is_click"),
        (F.col("k") == "view").cast("double").alias("is_view"),
        (F.col("k") == "error").cast("double").alias("is_error"),
        "dur")


def split_trips(trips: DataFrame, seed: int = 1) -> DataFrame:
    """The trips with their ``split``, computed once into the checkpoint
    folder, in parts of a bounded number of rows."""
    return reliable(train_test_split(ensure_parallelism(trips), "id", 0.7, seed=seed))


def run_flow(spark: SparkSession, d: str, n_clusters: int = 10, seed: int = 1, gbt_iter: int = 20,
             sample_rows: int | None = None):
    """Fit on the training split, transform both splits.  Returns
    (fitted PipelineModel, predictions DataFrame with a ``split`` column).
    ``sample_rows`` first takes an exact seeded sample (the studies used
    10,000 rows); by default every trip is used.  The located trips are
    computed once, into the checkpoint folder: the fit's rounds, the
    predictions and their users read them from there."""
    src = taxi_trips(spark, d)
    if sample_rows:
        src = sample_n(src, sample_rows, "id", seed=seed)
    trips = split_trips(src, seed)
    train = trips.filter(F.col("split") == "train").persist(StorageLevel.MEMORY_AND_DISK)
    model = duration_flow(LOC, BASE, "dur", n_clusters, seed=seed, gbt_iter=gbt_iter).fit(train)
    train.unpersist()
    return model, model.transform(trips).select("id", "split", "cluster", "predicted", "dur")


def compare_settings(trips: DataFrame, cluster_counts=(3, 10, 100), seed: int = 1) -> DataFrame:
    """MAE on train and test for each number of location clusters, from the
    ``split_trips``.  The flows are fitted in parallel where one does not
    fill the cores: there, others beside it would only hold their rows too."""
    from concurrent.futures import ThreadPoolExecutor
    spark = trips.sparkSession
    train = trips.filter(F.col("split") == "train").persist(StorageLevel.MEMORY_AND_DISK)

    def one(k):
        model = duration_flow(LOC, BASE, "dur", k, seed=seed).fit(train)
        m = model.transform(trips).groupBy("split") \
            .agg(F.avg(F.abs(F.col("predicted") - F.col("dur"))).alias("mae")).collect()
        by = {r["split"]: r["mae"] for r in m}
        return k, by.get("train"), by.get("test")
    full = trips.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    with ThreadPoolExecutor(max_workers=1 if full else len(cluster_counts)) as pool:
        rows = list(pool.map(one, cluster_counts))
    train.unpersist()
    return spark.createDataFrame(rows, "n_clusters int, mae_train double, mae_test double")
