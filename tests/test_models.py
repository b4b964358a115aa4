"""Trained models: shape, range, and better-than-baseline checks (their
numbers differ from the original libraries, so no exact values)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.models.flows import leaderboard, right_size, tree_flow, tree_grid_scores
from strata.models import trees
from strata.operators.ordering import kfold_assign, train_test_split
from strata.plans.cat_models import _clusters


def _acc(df):
    return df.agg(F.avg((F.col("cls") == F.col("predicted")).cast("double"))).first()[0]


def test_bounded_tree_keeps_its_bound_and_beats_chance(spark, small_dir):
    c = _clusters(spark, small_dir).cache()
    for bound in (3, 9):
        model = tree_flow(["x", "y"], "cls", bound).fit(c)
        p = model.transform(c)
        assert set(p.columns) == {*c.columns, "predicted"} and p.count() == c.count()
        assert model.stages[-1].n_leaves <= bound and p.filter("predicted is null").count() == 0
        assert p.select("predicted").distinct().count() <= bound
        assert _acc(p) > (0.4 if bound >= 5 else 0.13)          # 8 classes


def _grown(rows, labels, cuts, classes, max_nodes):
    """One leaf at a time, always the one of largest gain: (leaf class of each
    row, for every number of leaves on the way)."""
    rows, labels = np.array(rows, float), np.array([classes.index(y) for y in labels])

    def purity(counts):
        return float(sum(c * c for c in counts)) / sum(counts)

    def split(mine):
        total = [int((labels[mine] == c).sum()) for c in range(len(classes))]
        best = (-1.0, 0, 0)
        for f, ts in enumerate(cuts):
            for b, t in enumerate(ts):
                left = mine[rows[mine, f] <= t]
                right = mine[rows[mine, f] > t]
                if len(left) and len(right):
                    lc = [int((labels[left] == c).sum()) for c in range(len(classes))]
                    rc = [x - y for x, y in zip(total, lc)]
                    gain = purity(lc) + purity(rc) - purity(total)
                    if gain > best[0]:
                        best = (gain, f, b)
        return best, max(range(len(classes)), key=lambda i: (total[i], -i))
    leaves = [(0, np.arange(len(rows)), *split(np.arange(len(rows))))]
    found, boards = 1, []
    while True:
        out = np.zeros(len(rows))
        for _, mine, _, c in leaves:
            out[mine] = classes[c]
        boards.append(out)
        best = min(leaves, key=lambda x: (-x[2][0], x[0]))
        if len(leaves) == max_nodes or best[2][0] <= 1e-9:
            return boards
        leaves = [x for x in leaves if x is not best]
        _, mine, (_, f, b), _ = best
        for part in (mine[rows[mine, f] <= cuts[f][b]], mine[rows[mine, f] > cuts[f][b]]):
            leaves.append((found, part, *split(part)))
            found += 1


@pytest.mark.parametrize("max_nodes,cells", [(2, 1 << 15), (7, 0), (1 << 15, 1 << 15), (1 << 15, 300)])
def test_tree_equals_one_grown_leaf_by_leaf(spark, monkeypatch, max_nodes, cells):
    """Every bound on the way is a cut of the same tree; one-sided data, ties
    and constant features included; splits found on the driver or in Spark."""
    monkeypatch.setattr(trees, "CELLS", cells)
    rng = np.random.default_rng(max_nodes)
    n = 240
    x = np.column_stack([rng.normal(size=n).round(1), np.arange(n) % 7, np.full(n, 3.0), 2.0 ** (np.arange(n) % 30)])
    y = np.where(x[:, 3] > 100, 2.0, (x[:, 0] + rng.normal(size=n) > 0) * 1.0) + (x[:, 1] == 4) * 5.0
    df = spark.createDataFrame([(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, y double").repartition(3)
    cols = ["a", "b", "c", "d"]
    tree = trees.grow(df, cols, "y", max_nodes, bins=16)
    cuts = trees._thresholds(df, cols, 16)
    want = _grown(x, y, cuts, sorted(set(y)), max_nodes)
    assert trees.n_leaves(tree) == len(want) and (max_nodes > 7 or len(want) == max_nodes)
    leaf = {r["id"]: r["leaf"] for r in df.select("id", trees.leaf_of(tree, cols).alias("leaf")).collect()}
    for bound, board in enumerate(want, 1):
        classes = trees.leaf_classes(tree, bound)
        assert [classes[leaf[i]] for i in range(n)] == list(board)
        assert trees.n_leaves(tree, bound) == bound


def test_tree_of_awkward_rows(spark):
    nan = float("nan")
    rows = [(1.0, 0.0), (None, 1.0), (nan, 1.0), (2.0, 0.0), (3.0, None), (5.0, 0.0)] * 5
    df = spark.createDataFrame(rows, "x double, y double")
    model = trees.BoundedTree(inputCols=["x"], labelCol="y", maxNodes=4).fit(df)
    got = {(None if r["x"] is None else "nan" if r["x"] != r["x"] else r["x"]): r["predicted"] for r in model.transform(df).collect()}
    assert got[1.0] == got[2.0] == 0.0
    assert trees.grow(df.limit(0), ["x"], "y", 4)[0]["p"] != 0.0                    # no class
    one = trees.grow(df.where("y = 1"), ["x"], "y", 4)
    assert one == [{"p": 1.0}]


def test_stored_flow_predicts_the_same(spark, small_dir):
    from strata.models.flows import save_and_load_flow
    from strata.session import scratch_path
    c = _clusters(spark, small_dir)
    model = tree_flow(["x", "y"], "cls", 9, cluster_k=4).fit(c)
    stored = save_and_load_flow(model, scratch_path(spark, "flow"))
    assert stored.stages[-1].tree == model.stages[-1].tree and stored.stages[-1].uid == model.stages[-1].uid
    a = sorted((r["id"], r["predicted"], r["cluster"]) for r in model.transform(c).collect())
    assert a == sorted((r["id"], r["predicted"], r["cluster"]) for r in stored.transform(c).collect())


def test_leaderboard_figures_against_plain_trees(spark, small_dir):
    """Rows, right ones, leaves and metric of each setting, from trees grown leaf by leaf."""
    data = kfold_assign(_clusters(spark, small_dir), "id", k=3).cache()
    bounds = [2, 4, 16]
    got = {r["setting"]: r for r in leaderboard(tree_grid_scores(spark, data, "fold", 3, ["x", "y"], "cls", bounds)).collect()}
    scores = {f"tree-{b}": [] for b in bounds}
    for f in range(3):
        train, valid = data.filter(F.col("fold") != f), data.filter(F.col("fold") == f).collect()
        rows = train.collect()
        cuts = trees._thresholds(train, ["x", "y"], trees.BINS)
        points = [(r["x"], r["y"]) for r in rows] + [(r["x"], r["y"]) for r in valid]
        # held-out rows follow the splits found on the training rows
        tree = trees.grow(train, ["x", "y"], "cls", 16)
        boards = _grown([(r["x"], r["y"]) for r in rows], [r["cls"] for r in rows], cuts, sorted({r["cls"] for r in rows}), 16)
        leaf = {r["id"]: r["leaf"] for r in data.select("id", trees.leaf_of(tree, ["x", "y"]).alias("leaf")).collect()}
        assert len(points) == data.count()
        for b in bounds:
            classes = trees.leaf_classes(tree, b)
            assert [classes[leaf[r["id"]]] for r in rows] == list(boards[min(b, len(boards)) - 1])
            scores[f"tree-{b}"].append(sum(classes[leaf[r["id"]]] == r["cls"] for r in valid) / len(valid))
    want = sorted(((-max(s), -sum(s) / 3, name) for name, s in scores.items()))
    assert [got[name]["rank"] for _, _, name in want] == [1, 2, 3]
    for metric, mean, name in want:
        assert (got[name]["metric"], got[name]["mean"], got[name]["n_folds"]) == pytest.approx((-metric, -mean, 3))


def test_cluster_feature_flow(spark, small_dir):
    c = train_test_split(_clusters(spark, small_dir), "id", 0.7)
    model = tree_flow(["x", "y"], "cls", 32, cluster_k=8).fit(c.filter("split = 'train'"))
    p = model.transform(c.filter("split = 'test'"))
    assert p.agg(F.min("cluster"), F.max("cluster")).first() >= (0, 0) and p.agg(F.max("cluster")).first()[0] < 8
    assert _acc(p) > 0.4


def test_centres_do_not_depend_on_the_layout(spark, small_dir):
    from strata.models.clusters import fit_centres
    from strata.operators.spatial import lloyd_kmeans, nearest_centre
    from strata.operators.ordering import sample_n
    from strata.plans import views
    g = views.geo(spark, small_dir).select("id", "plat", "plong")
    cols = ["plat", "plong"]
    few, many = (fit_centres(g.repartition(n), cols, "id", 8) for n in (3, 300))
    assert few == many and len(few[0]) == 8

    def cost(centres):
        return nearest_centre(g, centres, cols, "c", "d").agg(F.sum("d")).first()[0]
    assert cost(few[0]) == pytest.approx(few[1], rel=1e-4)
    five_rounds = lloyd_kmeans(g, cols, [(r["plat"], r["plong"]) for r in sample_n(g, 8, "id").collect()], 5)
    assert cost(few[0]) <= cost(five_rounds)
    # a stationary point: each centre is the mean of its points
    means = nearest_centre(g, few[0], cols, "c").groupBy("c").agg(F.avg("plat"), F.avg("plong")).collect()
    for r in means:
        assert few[0][r[0]] == pytest.approx((r[1], r[2]), abs=1e-3)


def test_centres_of_few_and_odd_points(spark):
    from strata.models.clusters import fit_centres
    rows = [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 5.0, 5.0), (4, None, 1.0), (5, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    assert fit_centres(df, ["x", "y"], "id", 4) == ([(0.0, 0.0), (5.0, 5.0)], 0.0)
    assert fit_centres(df.limit(0), ["x", "y"], "id", 4) == ([], 0.0)


def test_cross_validated_least_squares(spark):
    """Every fold against numpy's fit of the other folds' rows."""
    from strata.models.learn import cross_validated_ols
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    x[:, 2] = np.arange(300) < 4                                   # constant in a fold's training rows
    y = 3 + x @ [1.5, -2, 4] + rng.normal(size=300)
    fold = np.where(np.arange(300) < 4, 0, np.arange(300) % 4)
    rows = [(int(f), float(v), *map(float, r)) for f, v, r in zip(fold, y, x)] + [(0, None, 1.0, 1.0, 1.0), (1, 2.0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "fold int, y double, a double, b double, c double").repartition(5)
    got: dict = {}
    for r in cross_validated_ols(spark, df, "y", ["a", "b", "c"], "fold").collect():
        got.setdefault(r["fold"], {})[r["term"]] = r
    assert set(got) == {0, 1, 2, 3}
    for f, terms in got.items():
        train, valid = fold != f, fold == f
        design = np.column_stack([np.ones(300), x])
        b = np.linalg.lstsq(design[train], y[train], rcond=None)[0]
        error = y[valid] - design[valid] @ b
        assert [terms[t]["coefficient"] for t in ("(intercept)", "a", "b", "c")] == pytest.approx(list(b), abs=1e-8)
        first = terms["a"]
        assert (first["n_train"], first["n_valid"]) == (train.sum(), valid.sum())
        assert first["rmse"] == pytest.approx(np.sqrt((error ** 2).mean()))
        assert first["r2"] == pytest.approx(1 - (error ** 2).sum() / ((y[valid] - y[valid].mean()) ** 2).sum())


def test_duration_flow_outputs(spark, small_dir):
    from strata.plans import taxi
    _, p = taxi.run_flow(spark, small_dir, n_clusters=5, gbt_iter=5)
    assert set(p.columns) == {"id", "split", "cluster", "predicted", "dur"}
    assert {r["split"] for r in p.groupBy("split").count().collect()} == {"train", "test"}
    assert p.filter(F.col("predicted").isNull()).count() == 0


def test_leaderboard_ranks_by_the_best_fold(spark):
    scores = spark.createDataFrame([("a", 0, 0.5), ("a", 1, 0.9), ("b", 0, 0.8), ("b", 1, 0.8), ("c", 0, 0.9), ("c", 1, 0.6)],
                                   "setting string, fold int, metric double")
    assert [r["setting"] for r in leaderboard(scores).collect()] == ["c", "a", "b"]
    assert [r["setting"] for r in leaderboard(scores, higher_is_better=False).collect()] == ["a", "c", "b"]


def test_tree_grid_scores_shape(spark, small_dir):
    c = right_size(kfold_assign(_clusters(spark, small_dir), "id", k=3))
    s = tree_grid_scores(spark, c, "fold", 3, ["x", "y"], "cls", [2, 16], cluster_k=8).collect()
    assert len(s) == 3 * 2 * 2
    assert {r["setting"] for r in s} == {"tree-2", "tree-16", "tree-2+cluster", "tree-16+cluster"}
    assert all(0.0 <= r["metric"] <= 1.0 for r in s)
    deep = [r["metric"] for r in s if r["setting"] == "tree-16"]
    shallow = [r["metric"] for r in s if r["setting"] == "tree-2"]
    assert sum(deep) > sum(shallow)     # a 2-leaf tree cannot separate 8 classes


def test_duration_flow_on_a_sample(spark, small_dir):
    from strata.plans import taxi
    _, pred = taxi.run_flow(spark, small_dir, n_clusters=3, sample_rows=300, gbt_iter=5)
    assert pred.count() == 300
