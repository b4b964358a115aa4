"""Feature building, k-means, least squares, baselines, trees, boosted
trees, cross-validation, grid search and the trip-duration flow."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.models import features as feat
from strata.models import learn
from strata.models.flows import leaderboard, right_size, save_and_load_flow, tree_flow, tree_grid_scores
from strata.operators.ordering import kfold_assign, train_test_split
from strata.plans import cat_daily  # noqa: F401  (registers ols_dow, reused below)
from strata.plans import daily as flow
from strata.plans import taxi, views
from strata.plans.cat_generate import CENTRES
from strata.plans.cat_spatial import nearest_centroid
from strata.plans.cat_verbs import _md5, _unit
from strata.plans.registry import ORACLE, query, rounded, sql_round
from strata.plans.views import with_views
from strata.session import scratch_path
from strata.sources import generators as gen
from strata.sources.tables import table

# Fold counts, node bounds and the one-hot vocabulary of the studies.
N_FIXED = 10        # one-hot vocabulary for the 8 sampled centres (two never occur)
CV_FOLDS = 5
TREE_CV_FOLDS = 20
GRID_FOLDS = 10
GRID_NODE_BOUNDS = [2 ** p for p in range(1, 16)]


@query("label_index", """
SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS label_idx
FROM orders""")
def label_index(spark, d):
    """Category -> number (alphabetical) with a fitted StringIndexer."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return feat.label_index(o, "o_orderpriority", "label_idx")


def _nearest_sql_body() -> str:
    sql = ORACLE["nearest_centroid"]
    return sql


@query("one_hot_fixed", "SELECT id, cluster, " + ", ".join(
    f'CASE WHEN cluster = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS "cluster-{i}"' for i in range(N_FIXED))
    + " FROM (" + _nearest_sql_body() + ")")
def one_hot_fixed(spark, d):
    """Cluster ids one-hot over the fixed vocabulary 0..9: ids that never
    occur still get an all-zero column."""
    a = nearest_centroid(spark, d)
    return feat.one_hot_range(a, "cluster", N_FIXED, drop_source=False)


@query("kmeans_lloyd_step", with_views(f"""
SELECT a.cluster, round(avg(g.plat), 6) AS plat, round(avg(g.plong), 6) AS plong, count(*) AS n
FROM ({_nearest_sql_body()}) a JOIN geo g ON a.id = g.id GROUP BY a.cluster""", "geo"))
def kmeans_lloyd_step(spark, d):
    """One Lloyd step: assign to the nearest of the 8 seeded centres, then
    move each centre to the mean of its points."""
    a = nearest_centroid(spark, d)
    g = views.geo(spark, d)
    return rounded(a.join(g, "id").groupBy("cluster").agg(
        F.avg("plat").alias("plat"), F.avg("plong").alias("plong"), F.count(F.lit(1)).alias("n")))


LLOYD_ROUNDS = 5


def _lloyd_sql(rounds: int) -> str:
    """Unrolled Lloyd iterations as DuckDB CTEs (c0 = seeded sample)."""
    ctes = [f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY {_md5('id')}, id) - 1 AS INTEGER) AS cluster,
                 plat, plong FROM geo ORDER BY {_md5('id')}, id LIMIT 8)"""]
    for i in range(1, rounds + 1):
        prev = f"c{i - 1}"
        ctes.append(f"""a{i} AS (SELECT id, plat, plong, cluster FROM (
            SELECT g.id, g.plat, g.plong, c.cluster, row_number() OVER (PARTITION BY g.id ORDER BY
              (g.plat - c.plat) * (g.plat - c.plat) + (g.plong - c.plong) * (g.plong - c.plong), c.cluster) AS r
            FROM geo g, {prev} c) WHERE r = 1)""")
        ctes.append(f"""c{i} AS (SELECT p.cluster, coalesce(m.plat, p.plat) AS plat, coalesce(m.plong, p.plong) AS plong
            FROM {prev} p LEFT JOIN (SELECT cluster, avg(plat) AS plat, avg(plong) AS plong FROM a{i} GROUP BY cluster) m
            ON p.cluster = m.cluster)""")
    ctes.append(f"""fin AS (SELECT id, cluster FROM (
            SELECT g.id, c.cluster, row_number() OVER (PARTITION BY g.id ORDER BY
              (g.plat - c.plat) * (g.plat - c.plat) + (g.plong - c.plong) * (g.plong - c.plong), c.cluster) AS r
            FROM geo g, c{rounds} c) WHERE r = 1)""")
    return with_views(f"""
SELECT c.cluster, round(c.plat, 6) AS plat, round(c.plong, 6) AS plong,
       (SELECT count(*) FROM fin WHERE fin.cluster = c.cluster) AS n
FROM c{rounds} c""", "geo", ctes=tuple(ctes))


@query("kmeans_lloyd", _lloyd_sql(LLOYD_ROUNDS))
def kmeans_lloyd(spark, d):
    """Five Lloyd rounds from 8 seeded centres; final centres and sizes."""
    from strata.operators.spatial import nearest_centre
    g, centres = _lloyd_centres(spark, d)
    sizes = nearest_centre(g, centres, ["plat", "plong"]).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    table_ = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(centres)],
                                   "cluster int, plat double, plong double")
    return rounded(table_.join(sizes, "cluster", "left").fillna({"n": 0}))


def _lloyd_centres(spark, d):
    from strata.operators.ordering import sample_n
    from strata.operators.spatial import lloyd_kmeans
    g = views.geo(spark, d).select("id", "plat", "plong")
    init = [(r["plat"], r["plong"]) for r in sample_n(g, 8, "id").collect()]
    return g, lloyd_kmeans(g, ["plat", "plong"], init, LLOYD_ROUNDS)


_LLOYD = _lloyd_sql(LLOYD_ROUNDS).rsplit("SELECT c.cluster, round", 1)[0]


@query("kmeans_fit", _LLOYD + "SELECT id, cluster FROM fin")
def kmeans_fit(spark, d):
    """k-means from 8 seeded centres on all pickup points; cluster per point."""
    from strata.operators.spatial import nearest_centre
    g, centres = _lloyd_centres(spark, d)
    return nearest_centre(g, centres, ["plat", "plong"]).select("id", F.col("cluster").cast("int").alias("cluster"))


@query("kmeans_centers", _LLOYD + f"SELECT cluster, round(plat, 6) AS plat, round(plong, 6) AS plong FROM c{LLOYD_ROUNDS}")
def kmeans_centers(spark, d):
    """The fitted centres as a table (k rows)."""
    _, centres = _lloyd_centres(spark, d)
    return rounded(spark.createDataFrame([(i, *c) for i, c in enumerate(centres)],
                                         "cluster int, plat double, plong double"))


_GOODS_LOG = "(SELECT l_orderkey, l_linenumber, l_extendedprice AS price, ln(l_extendedprice) AS y, ln(l_quantity) AS x " \
             "FROM lineitem WHERE l_extendedprice > 0 AND l_quantity > 0)"


def _log_goods(spark, d):
    g = views.goods(spark, d).filter((F.col("price") > 0) & (F.col("carat") > 0))
    return g.withColumns({"y": F.ln("price"), "x": F.ln("carat")})


@query("ols_loglog", f"""
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n FROM {_GOODS_LOG}""")
def ols_loglog(spark, d):
    """Least squares of log price on log quantity (single regressor)."""
    g = _log_goods(spark, d)
    return rounded(g.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                         F.regr_r2("y", "x").alias("r2"), F.regr_count("y", "x").cast("bigint").alias("n")))


@query("predict_backtransform", f"""
SELECT l_orderkey, l_linenumber, round(exp(b + a * x), 2) AS predicted_price,
       round(price - exp(b + a * x), 2) AS residual
FROM {_GOODS_LOG} g, (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM {_GOODS_LOG}) m""")
def predict_backtransform(spark, d):
    """Log-log model predictions back-transformed with exp, and residuals.
    The two coefficients are scalar subqueries (one row), not a join."""
    g = _log_goods(spark, d)
    a = g.select(F.regr_slope("y", "x")).scalar()
    b = g.select(F.regr_intercept("y", "x")).scalar()
    pred = F.exp(b + a * F.col("x"))
    return g.select("l_orderkey", "l_linenumber", F.round(pred, 2).alias("predicted_price"),
                    F.round(F.col("price") - pred, 2).alias("residual"))


def _trips_split(spark, d):
    t = views.trips(spark, d).select("id", "dur")
    return train_test_split(t, "id", 0.7)


_SPLIT_SQL = f"(SELECT event_id AS id, value AS dur, {_unit('event_id')} < 0.7 AS is_train FROM events)"
_MEAN_SQL = (f"(SELECT CAST(sum(CAST(dur AS DECIMAL(38, 2))) AS DOUBLE) / count(dur) AS mean "
             f"FROM {_SPLIT_SQL} WHERE is_train)")


def _mean_predictions(spark, d):
    t = _trips_split(spark, d)
    fitted = learn.mean_model_fit(t.filter(F.col("split") == "train"), "dur", decimal_scale=2)
    return learn.mean_model_predict(t.filter(F.col("split") == "test"), fitted)


@query("mean_model", f"""
SELECT id, {sql_round('mean')} AS predicted, dur FROM {_SPLIT_SQL} t, {_MEAN_SQL} m WHERE NOT is_train""")
def mean_model(spark, d):
    """Baseline: the training-split mean duration predicted for every test trip."""
    return rounded(_mean_predictions(spark, d).select("id", "predicted", "dur"))


@query("mae", f"""
SELECT round(avg(abs(mean - dur)), 6) AS mae FROM {_SPLIT_SQL} t, {_MEAN_SQL} m WHERE NOT is_train""")
def mae(spark, d):
    """Mean absolute error of the baseline on the test split."""
    from strata.operators.aggregates import mae as mae_agg
    return rounded(mae_agg(_mean_predictions(spark, d), "predicted", "dur"))


@query("log_pred_actual", f"""
SELECT id, round(ln(mean), 6) AS log_predicted, round(CASE WHEN dur > 0 THEN ln(dur) END, 6) AS log_actual
FROM {_SPLIT_SQL} t, {_MEAN_SQL} m WHERE NOT is_train""")
def log_pred_actual(spark, d):
    p = _mean_predictions(spark, d)
    return rounded(p.select("id", F.ln("predicted").alias("log_predicted"),
                            F.when(F.col("dur") > 0, F.ln("dur")).alias("log_actual")))


_CV_SQL = f"""
WITH t AS (SELECT event_id AS id, value AS dur,
                  CAST((row_number() OVER (ORDER BY {_md5('event_id')}, event_id) - 1) % {CV_FOLDS} AS INTEGER) AS fold
           FROM events),
s AS (SELECT fold, sum(CAST(dur AS DECIMAL(38, 2))) AS s, count(*) AS n FROM t GROUP BY fold),
tot AS (SELECT sum(CAST(dur AS DECIMAL(38, 2))) AS s, count(*) AS n FROM t),
m AS (SELECT s.fold, CAST(tot.s - s.s AS DOUBLE) / (tot.n - s.n) AS mean FROM s, tot),
scores AS (SELECT 'mean_model' AS setting, t.fold, avg(abs(t.dur - m.mean)) AS metric
           FROM t JOIN m ON t.fold = m.fold GROUP BY t.fold)"""


def _cv_mean_scores(spark, d):
    """Mean-model CV in one pass: per-fold sums give every fold's training
    mean as (total - fold) / (N - n_fold); no per-fold refit job."""
    t = kfold_assign(views.trips(spark, d).select("id", "dur"), "id", k=CV_FOLDS)
    dec = F.col("dur").cast("decimal(38,2)")
    per = t.groupBy("fold").agg(F.sum(dec).alias("s"), F.count(F.lit(1)).alias("n"))
    tot_s = per.select(F.sum("s")).scalar()           # k rows
    tot_n = per.select(F.sum("n")).scalar()
    means = per.select("fold", ((tot_s - F.col("s")).cast("double") / (tot_n - F.col("n"))).alias("mean"))
    # k rows: a proven bound
    scored = t.join(F.broadcast(means), "fold")
    return scored.groupBy("fold").agg(F.avg(F.abs(F.col("dur") - F.col("mean"))).alias("metric")) \
        .select(F.lit("mean_model").alias("setting"), "fold", "metric")


@query("cv_mean_model", _CV_SQL + f"\nSELECT setting, fold, {sql_round('metric')} AS metric FROM scores")
def cv_mean_model(spark, d):
    """5-fold cross-validated MAE of the mean model, per fold."""
    return rounded(_cv_mean_scores(spark, d))


@query("cv_summary", _CV_SQL + f"""
SELECT setting, {sql_round('min(metric)')} AS min, {sql_round('avg(metric)')} AS mean,
       {sql_round('max(metric)')} AS max FROM scores GROUP BY setting""")
def cv_summary(spark, d):
    """min / mean / max of the fold metric per setting."""
    from strata.operators.aggregates import metric_summary
    return rounded(metric_summary(_cv_mean_scores(spark, d), ["setting"], "metric"))


@query("cv_best_fold", _CV_SQL + f"""
SELECT setting, fold, {sql_round('metric')} AS metric FROM (
  SELECT *, row_number() OVER (PARTITION BY setting ORDER BY metric, fold) AS rk FROM scores) WHERE rk = 1""")
def cv_best_fold(spark, d):
    """Cross-validation reporting only the best fold per setting (lowest MAE)."""
    from strata.operators.aggregates import best_fold
    return rounded(best_fold(_cv_mean_scores(spark, d), ["setting"], "metric", higher_is_better=False))


@query("model_roundtrip", ORACLE["ols_dow"])
def model_roundtrip(spark, d):
    """The weekday least-squares model saved to shared storage, loaded
    back and explained: same terms as before saving."""
    model = flow.weekday_model(spark, d)
    loaded = learn.save_and_load_linear(model, scratch_path(spark, "weekday-ols"))
    return rounded(learn.explain_linear(spark, loaded, flow.DUMMIES))


# ------------------------------------------------------------ trained models
def _clusters(spark, d):
    # the points are computed from one narrow column, which a large table holds in a few small splits
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("id")).repartition(parts, "id")
    return gen.gaussian_clusters(keys, "id", CENTRES, seed=11).withColumn("cls", F.col("cls").cast("double"))


def _against_mean(pred):
    """Facts about real predictions (split, predicted, dur) per split: rows,
    non-null predictions, and whether the absolute error on the training
    split is below that of the training mean."""
    mean = pred.filter(F.col("split") == "train").select(F.avg("dur")).scalar()
    each = pred.select("split", "predicted", F.abs(F.col("predicted") - F.col("dur")).alias("e"),
                       F.abs(F.col("dur") - mean).alias("base"))
    per = each.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("predicted").alias("n_predicted"),
                                    (F.avg("e") < F.avg("base")).alias("better"))
    flag = F.max(F.when(F.col("split") == "train", F.col("better"))).over(Window.partitionBy(F.lit(0)))   # 2 rows
    return per.select("split", "n", "n_predicted", flag.alias("train_better_than_mean"))


_SPLIT_FACTS = (f"SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, count(*) AS n, "
                f"count(*) AS n_predicted, true AS train_better_than_mean FROM {_SPLIT_SQL} GROUP BY 1")


@query("gbt_regression", _SPLIT_FACTS)
def gbt_regression(spark, d):
    """Boosted-tree regression of trip duration (time and type features),
    fitted on the training split: predictions per split, and whether those
    on the training split beat its mean."""
    t = train_test_split(taxi.taxi_trips(spark, d), "id", 0.7)
    train = t.filter(F.col("split") == "train")
    model = learn.fit_gbt(train, "dur", taxi.BASE, max_iter=20, seed=1)
    return _against_mean(learn.predict_model(t, model, taxi.BASE))


_CLUSTERS_SQL = "(SELECT c_custkey AS id, CAST(c_custkey % 8 AS DOUBLE) AS cls FROM customer)"


def _against_majority(pred, by: list[str]):
    """Rows and predictions, and whether more are right than the rows of the
    most frequent class."""
    per = pred.groupBy(*by, "cls").agg(F.count(F.lit(1)).alias("n"), F.count("predicted").alias("p"),
                                       F.count_if(F.col("predicted") == F.col("cls")).alias("right"))
    return per.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("p").alias("n_predicted"),
                                (F.sum("right") > F.max("n")).alias("better_than_majority"))


@query("decision_tree", f"""
SELECT count(*) AS n, count(*) AS n_predicted, true AS better_than_majority, 5 AS max_leaves,
       true AS within_bound FROM {_CLUSTERS_SQL}""")
def decision_tree(spark, d):
    """Decision-tree classifier of at most 5 leaves on the 8-centre set: its
    predictions against the majority class, and its leaves against the bound."""
    c = _clusters(spark, d)
    model = tree_flow(["x", "y"], "cls", 5).fit(c)
    return _against_majority(model.transform(c), []).withColumns({
        "max_leaves": F.lit(5), "within_bound": F.lit(model.stages[-1].n_leaves <= 5)})


@query("cluster_feature_model", f"""
SELECT count(*) AS n, count(*) AS n_predicted, true AS better_than_majority
FROM {_CLUSTERS_SQL} WHERE NOT ({_unit('id')} < 0.7)""")
def cluster_feature_model(spark, d):
    """Fit/transform flow: k-means cluster one-hot (fitted on train only)
    added to the tree's inputs; its predictions on the test split."""
    c = train_test_split(_clusters(spark, d), "id", 0.7)
    model = tree_flow(["x", "y"], "cls", 32, cluster_k=8).fit(c.filter(F.col("split") == "train"))
    return _against_majority(model.transform(c.filter(F.col("split") == "test")), [])


@query("taxi_duration_model", _SPLIT_FACTS)
def taxi_duration_model(spark, d):
    """Flagship flow: location clusters + time features -> boosted trees;
    fitted state only (centres, trees) is carried to the test split."""
    _, pred = taxi.run_flow(spark, d, n_clusters=10)
    return _against_mean(pred)


@query("hyper_compare", f"""
SELECT k AS n_clusters, true AS train_better_than_mean, true AS has_test
FROM (VALUES (3), (10), (100)) t(k) WHERE (SELECT count(*) FROM {_SPLIT_SQL} WHERE NOT is_train) > 0""")
def hyper_compare(spark, d):
    """Train / test error of the duration flow for 3, 10 and 100 clusters,
    against the error of the training mean."""
    trips = taxi.split_trips(taxi.taxi_trips(spark, d))
    scores = taxi.compare_settings(trips, (3, 10, 100))
    train = trips.filter(F.col("split") == "train")
    mean = train.select(F.avg("dur")).scalar()
    base = train.select(F.abs(F.col("dur") - mean).alias("e")).select(F.avg("e")).scalar()
    return scores.select("n_clusters", (F.col("mae_train") < base).alias("train_better_than_mean"),
                         F.col("mae_test").isNotNull().alias("has_test"))


def _folds_sql(rows: str, key: str, k: int) -> str:
    return (f"(SELECT *, CAST((row_number() OVER (ORDER BY {_md5(key)}, {key}) - 1) % {k} AS INTEGER) AS fold "
            f"FROM {rows})")


@query("cv_decision_tree", f"""
SELECT setting, fold, n_valid, true AS better_than_chance
FROM (SELECT fold, count(*) AS n_valid FROM {_folds_sql(_CLUSTERS_SQL, 'id', TREE_CV_FOLDS)} GROUP BY fold),
     (VALUES ('tree-5'), ('tree-5+cluster')) t(setting)""")
def cv_decision_tree(spark, d):
    """20-fold accuracy of a 5-leaf tree with and without the cluster
    feature; its mean against one class in 8."""
    c = right_size(kfold_assign(_clusters(spark, d), "id", k=TREE_CV_FOLDS))
    scores = tree_grid_scores(spark, c, "fold", TREE_CV_FOLDS, ["x", "y"], "cls", [5], cluster_k=8)
    c.unpersist()
    mean = F.avg("metric").over(Window.partitionBy("setting"))        # a row for each fold
    return scores.select("setting", "fold", "n_valid", (mean > 0.125).alias("better_than_chance"))


@query("grid_leaderboard")
def grid_leaderboard(spark, d):
    """15 node bounds x cluster feature on/off, 10 folds each, on the
    training split, best fold first: the leaves of the largest of the
    setting's trees, its held-out rows and how many were right, and the
    metric of the best fold with the mean over the folds."""
    train = train_test_split(_clusters(spark, d), "id", 0.7).filter(F.col("split") == "train").drop("split")
    c = right_size(kfold_assign(train, "id", k=GRID_FOLDS))
    scores = tree_grid_scores(spark, c, "fold", GRID_FOLDS, ["x", "y"], "cls", GRID_NODE_BOUNDS, cluster_k=8)
    c.unpersist()
    grown = scores.groupBy("setting").agg(F.max("leaves").alias("leaves"), F.sum("n_valid").alias("n_valid"),
                                          F.sum("n_right").alias("n_right"))
    return rounded(leaderboard(scores).join(grown, "setting").select(
        "rank", "setting", "leaves", "n_valid", "n_right", F.col("n_folds").cast("int").alias("n_folds"), "metric", "mean"))


# mean models per group of the trips: each fold is predicted by the mean of the other folds' group
MEAN_MODELS = {"mean": "0", "mean-by-type": "k", "mean-by-hour": "hour(pickup)"}


def _mean_board_sql() -> str:
    parts = [f"""SELECT '{name}' AS setting, fold, sum(CAST(abs(dur - m) AS DECIMAL(38, 6))) / count(*) AS metric FROM (
      SELECT fold, dur, CAST(CAST((gs - fs) AS DOUBLE) / (gn - fn) AS DECIMAL(18, 6)) AS m FROM (
        SELECT fold, CAST(dur AS DECIMAL(18, 2)) AS dur,
               sum(CAST(dur AS DECIMAL(18, 2))) OVER (PARTITION BY {key}) AS gs, count(*) OVER (PARTITION BY {key}) AS gn,
               sum(CAST(dur AS DECIMAL(18, 2))) OVER (PARTITION BY {key}, fold) AS fs,
               count(*) OVER (PARTITION BY {key}, fold) AS fn FROM f) WHERE gn > fn) GROUP BY fold"""
             for name, key in MEAN_MODELS.items()]
    return f"""
WITH f AS (SELECT id, dur, k, pickup, fold FROM {_folds_sql("(SELECT event_id AS id, value AS dur, event_type AS k, ts AS pickup FROM events)", "id", CV_FOLDS)}),
scores AS ({" UNION ALL ".join(parts)})
SELECT CAST(row_number() OVER (ORDER BY min(metric), avg(CAST(metric AS DOUBLE)), setting) AS INTEGER) AS rank, setting,
       round(CAST(min(metric) AS DOUBLE), 4) AS metric, round(avg(CAST(metric AS DOUBLE)), 4) AS mean,
       count(*) AS n_folds FROM scores GROUP BY setting"""


@query("mean_leaderboard", _mean_board_sql())
def mean_leaderboard(spark, d):
    """Leaderboard of mean models (all trips, per type, per hour): metric of
    the best fold and mean over 5 folds.  One pass per setting: a fold's
    prediction is its group's total less the fold's own."""
    t = kfold_assign(views.trips(spark, d).select("id", "dur", "k", "pickup"), "id", k=CV_FOLDS)
    dur = F.col("dur").cast("decimal(18,2)")
    boards = []
    for name, key in MEAN_MODELS.items():
        rows = t.select("fold", F.expr(key).alias("g"), dur.alias("dur"))
        per = rows.groupBy("g", "fold").agg(F.sum("dur").alias("fs"), F.count(F.lit(1)).alias("fn"))
        whole = per.groupBy("g").agg(F.sum("fs").alias("gs"), F.sum("fn").alias("gn"))
        means = per.join(whole, "g").where("gn > fn").select(
            "g", "fold", ((F.col("gs") - F.col("fs")).cast("double") / (F.col("gn") - F.col("fn")))
            .cast("decimal(18,6)").alias("m"))
        boards.append(rows.join(means, ["g", "fold"]).groupBy("fold").agg(
            (F.sum(F.abs(F.col("dur") - F.col("m")).cast("decimal(38,6)")).cast("double") / F.count(F.lit(1)))
            .alias("metric")).select(F.lit(name).alias("setting"), "fold", "metric"))
    scores = boards[0].unionByName(boards[1]).unionByName(boards[2])
    return rounded(leaderboard(scores, higher_is_better=False), 4)


CV_OLS_FOLDS = 5


def _cv_ols_sql() -> str:
    days = with_views("SELECT date, n, day_of_week FROM daily_with_dow", "daily_with_dow")
    return f"""
WITH f AS (SELECT * FROM {_folds_sql("(" + days + ")", "date", CV_OLS_FOLDS)}),
k AS (SELECT DISTINCT fold FROM f),
m AS (SELECT k.fold, day_of_week, avg(n) AS m FROM k JOIN f ON f.fold <> k.fold GROUP BY 1, 2),
size AS (SELECT k.fold, count(*) AS n_train FROM k JOIN f ON f.fold <> k.fold GROUP BY 1),
score AS (SELECT f.fold, count(*) AS n_valid, sum((n - m) * (n - m)) AS error, var_pop(n) * count(*) AS spread
          FROM f JOIN m ON m.fold = f.fold AND m.day_of_week = f.day_of_week GROUP BY 1)
SELECT s.fold, n_train, n_valid, round(sqrt(error / n_valid), 6) AS rmse, round(1 - error / spread, 6) AS r2,
       CASE WHEN a.day_of_week = 'Mon' THEN '(intercept)' ELSE 'day_of_week-' || a.day_of_week END AS term,
       round(a.m - CASE WHEN a.day_of_week = 'Mon' THEN 0 ELSE b.m END, 6) AS coefficient
FROM score s JOIN size USING (fold) JOIN m a ON a.fold = s.fold JOIN m b ON b.fold = s.fold AND b.day_of_week = 'Mon'"""


@query("cv_ols_dow", _cv_ols_sql())
def cv_ols_dow(spark, d):
    """The weekday regression cross-validated over 5 folds of days: each
    fold's coefficients, error and share of variance, from one scan."""
    days = kfold_assign(flow.weekday_onehot(spark, d), "date", k=CV_OLS_FOLDS)
    return rounded(learn.cross_validated_ols(spark, days, "n", flow.DUMMIES, "fold"))


@query("kmeans_converged")
def kmeans_converged(spark, d):
    """k-means of all pickup points from oversampled starting centres, run
    until the cost hardly falls: centres, sizes and each cluster's cost."""
    from strata.models.clusters import fit_centres
    from strata.operators.spatial import nearest_centre
    g = views.geo(spark, d).select("id", "plat", "plong")
    centres, _ = fit_centres(g, ["plat", "plong"], "id", 8)
    near = nearest_centre(g, centres, ["plat", "plong"], "cluster", "_d").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_d").cast("decimal(38,12)")).alias("cost"))
    table_ = spark.createDataFrame([(i, *c) for i, c in enumerate(centres)], "cluster int, plat double, plong double")
    return rounded(table_.join(near, "cluster", "left").fillna({"n": 0}))


@query("flow_roundtrip", f"""
SELECT count(*) AS n, count(*) AS n_predicted, true AS better_than_majority, CAST(0 AS BIGINT) AS n_changed
FROM {_CLUSTERS_SQL} WHERE NOT ({_unit('id')} < 0.7)""")
def flow_roundtrip(spark, d):
    """The cluster-feature flow fitted on the training split, written to
    shared storage and read back with its centres and its tree: predictions
    of the test split by the stored flow, and how many the one in memory
    would make otherwise."""
    c = train_test_split(_clusters(spark, d), "id", 0.7)
    test = c.filter(F.col("split") == "test")
    model = tree_flow(["x", "y"], "cls", 32, cluster_k=8).fit(c.filter(F.col("split") == "train"))
    stored = save_and_load_flow(model, scratch_path(spark, "cluster-flow"))
    both = stored.transform(test).withColumnRenamed("predicted", "_stored").drop("cluster", "_loc", *[f"cluster-{i}" for i in range(8)])
    both = model.transform(both).withColumn("_changed", (~F.col("predicted").eqNullSafe(F.col("_stored"))).cast("long"))
    changed = both.agg(F.sum("_changed")).first()[0]
    return _against_majority(both.drop("predicted").withColumnRenamed("_stored", "predicted"), []).withColumn(
        "n_changed", F.lit(changed or 0).cast("long"))
