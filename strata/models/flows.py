"""Fit / transform flows, cross-validation and grid search.

A flow is a ``pyspark.ml.Pipeline``: fitted on training rows it becomes a
``PipelineModel`` that carries only fitted state (cluster centres, trees)
to the test rows.  Cross-validation assigns folds by key hash (same
folds on any layout) and fits the (setting, fold) pairs from a driver
thread pool; every fit is itself a distributed job.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.models.trees import BoundedTree, leaf_classes, n_leaves
from strata.session import reliable


def one_hot_stage(col: str, n: int, prefix: str | None = None) -> SQLTransformer:
    """Pipeline stage: one-hot over the fixed vocabulary 0..n-1, so train
    and test get the same columns even when a value is absent."""
    prefix = prefix or col
    cases = ", ".join(f"CASE WHEN `{col}` = {i} THEN 1.0 ELSE 0.0 END AS `{prefix}-{i}`" for i in range(n))
    return SQLTransformer(statement=f"SELECT *, {cases} FROM __THIS__")


def cluster_stages(loc_cols: list[str], k: int, seed: int = 1, out_col: str = "cluster"):
    """Stages: assemble location -> k-means (fit on training rows only)."""
    return [VectorAssembler(inputCols=loc_cols, outputCol="_loc", handleInvalid="keep"),
            KMeans(k=k, seed=seed, featuresCol="_loc", predictionCol=out_col, maxIter=20)]


def cluster_feature_stages(loc_cols: list[str], k: int, seed: int = 1, out_col: str = "cluster"):
    """Stages: ``cluster_stages`` -> fixed-vocabulary one-hot of the cluster id."""
    return cluster_stages(loc_cols, k, seed, out_col) + [one_hot_stage(out_col, k)]


def duration_flow(loc_cols: list[str], base_features: list[str], label: str, n_clusters: int,
                  seed: int = 1, gbt_iter: int = 20) -> Pipeline:
    """Location clusters as one-hot features plus ``base_features`` ->
    gradient-boosted regression of ``label``.  The one-hot values are one
    sparse vector, of as many entries as k-means has centres: a column for
    each of 100 clusters takes longer than all trees."""
    return Pipeline(stages=cluster_stages(loc_cols, n_clusters, seed) + [
        OneHotEncoder(inputCol="cluster", outputCol="_hot", dropLast=False),
        VectorAssembler(inputCols=base_features + ["_hot"], outputCol="_features", handleInvalid="keep"),
        GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="predicted",
                     maxIter=gbt_iter, maxDepth=5, seed=seed)])


def tree_flow(features: list[str], label: str, max_nodes: int, cluster_k: int | None = None,
              seed: int = 1, leaf_col: str = "") -> Pipeline:
    """Decision-tree classifier of at most ``max_nodes`` leaves, optionally
    with a k-means cluster one-hot of the same features as extra inputs."""
    stages, inputs = [], list(features)
    if cluster_k:
        stages += cluster_feature_stages(features, cluster_k, seed)
        inputs += [f"cluster-{i}" for i in range(cluster_k)]
    return Pipeline(stages=stages + [BoundedTree(inputCols=inputs, labelCol=label, maxNodes=max_nodes, leafCol=leaf_col)])


def save_and_load_flow(model: PipelineModel, path: str) -> PipelineModel:
    """Write a fitted flow, with the state of every stage, to shared storage
    and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


ROWS_OF_A_TASK = 400_000  # of a fit's input: a boosted fit holds about 1 kB for a row of 116 features


def ensure_parallelism(df: DataFrame, rows_per_task: int = ROWS_OF_A_TASK) -> DataFrame:
    """A fit's input dealt evenly over as many tasks as its rows call for, at
    least ``defaultParallelism``, whatever files or shuffle it comes from: a
    scan deals a few large splits, some of them empty, and a shuffle may deal
    more parts than the fit's many jobs should have tasks."""
    want = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartition(want)


def right_size(df: DataFrame, rows_per_partition: int = 200_000) -> DataFrame:
    """Persist ``df`` with about ``rows_per_partition`` rows per task.

    Model search runs hundreds of small fits over the same rows; tiny
    inputs spread over hundreds of tasks spend their time scheduling.
    Large inputs keep (at least) their partitioning.  The rows are computed
    once, into the checkpoint folder, and counted there."""
    df = reliable(df)
    have = df.rdd.getNumPartitions()
    if have <= 1:                       # nothing to merge: skip the count job
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    n = df.count()
    want = max(1, -(-n // rows_per_partition))
    out = df.coalesce(want) if want < have else df
    return out.persist(StorageLevel.MEMORY_AND_DISK)


def tree_grid_scores(spark: SparkSession, data: DataFrame, fold_col: str, k: int, features: list[str],
                     label: str, node_bounds: list[int], cluster_k: int | None = None,
                     parallelism: int = 8, seed: int = 1) -> DataFrame:
    """Accuracy of decision trees for every node bound, with and without a
    k-means cluster feature, on every fold: (setting, fold, n_valid, n_right,
    leaves, metric).

    Per (fold, variant) one tree is grown to the largest bound; each smaller
    bound is a cut of it (``trees.leaf_classes``).  The held-out rows are
    counted per (leaf, label), which scores all bounds at once.  Work shared
    between settings (the fold's cluster stage) is done once; (fold,
    variant) tasks run from a thread pool.
    """
    variants = [False] + ([True] if cluster_k else [])
    tasks = [(f, wc) for f in range(k) for wc in variants]

    def run(task):
        f, wc = task
        train = data.filter(F.col(fold_col) != f)
        flow = tree_flow(features, label, max(node_bounds), cluster_k if wc else None, seed, leaf_col="_leaf")
        model = flow.fit(train)
        tree = model.stages[-1].tree
        # leaves x labels: as many rows as the fitted tree has
        counts = model.transform(data.filter(F.col(fold_col) == f)).groupBy("_leaf", label).count().collect()
        n = sum(r["count"] for r in counts)
        out = []
        for nb in node_bounds:
            classes = leaf_classes(tree, nb)
            right = sum(r["count"] for r in counts if classes[r["_leaf"]] == r[label])
            out.append((f"tree-{nb}" + ("+cluster" if wc else ""), f, n, right, n_leaves(tree, nb), right / n if n else None))
        return out
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = [r for chunk in pool.map(run, tasks) for r in chunk]
    return spark.createDataFrame(rows, "setting string, fold int, n_valid long, n_right long, leaves int, metric double")


def leaderboard(scores: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """(rank, setting, metric of the best fold, mean over the folds,
    n_folds), best first; equal metrics by the mean, then by name.  One row
    per setting is ranked."""
    best = F.max("metric") if higher_is_better else F.min("metric")
    board = scores.groupBy("setting").agg(best.alias("metric"), F.avg("metric").alias("mean"),
                                          F.count("metric").alias("n_folds"))
    order = [F.col(c).desc() if higher_is_better else F.col(c).asc() for c in ("metric", "mean")]
    rank = F.row_number().over(Window.orderBy(*order, "setting"))
    return board.select(rank.alias("rank"), "*").orderBy("rank")
