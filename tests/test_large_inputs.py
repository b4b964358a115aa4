"""Inputs that only large tables hold, in small copies built here."""
import math

from pyspark.sql import functions as F

from strata.operators import spatial


def _holds(px, py, edges):
    """The join's rule: on an edge, or an odd number of them to the right."""
    odd = False
    for (x1, y1), (x2, y2) in edges:
        side = (px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)
        if side == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return True
        if (y1 > py) != (y2 > py) and side * math.copysign(1, y2 - y1) < 0:
            odd = not odd
    return odd


def test_polygons_with_vertices_outside_of_a_projection(spark):
    nan = float("nan")
    rings = {1: [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (nan, nan), (0.0, 0.0)],           # open
             2: [(900.0, 10.0), (904.0, 10.0), (904.0, nan), (900.0, 14.0), (900.0, 10.0)],
             3: [(nan, nan)] * 5,
             4: [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)]}
    rows = [(k, f"p{k}", [[{"x": x, "y": y} for x, y in r]]) for k, r in rings.items()]
    polys = spark.createDataFrame(rows, "poly_id long, name string, rings array<array<struct<x:double,y:double>>>")
    at = [(i / 2 - 3, j / 2 - 1) for i in range(18) for j in range(12)] + [(901.0, 12.0), (-5000.0, 2.0), (nan, 2.0), (2.0, nan)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(at)], "id long, x double, y double")
    want = set()
    for k, r in rings.items():
        edges = [e for e in zip(r, r[1:]) if all(math.isfinite(v) for p in e for v in p)]
        want |= {(i, k) for i, (x, y) in enumerate(at) if _holds(x, y, edges)}
    got = [(r["id"], r["poly_id"]) for r in spatial.spatial_join(points, polys).collect()]
    assert sorted(got) == sorted(want) and {k for _, k in want} >= {1, 4}


def test_far_polygons_take_no_cells_without_end(spark):
    """A square that ends beyond the projection, a million units away."""
    ring = [(1e6, 2e7), (1e6 + 9e3, 2e7), (float("nan"), float("nan")), (1e6, 2e7 + 9e3), (1e6, 2e7)]
    polys = spark.createDataFrame([(1, "a", [[{"x": x, "y": y} for x, y in ring]])],
                                  "poly_id long, name string, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 1e6 + 10, 2e7 + 10), (2, 0.0, 0.0)], "id long, x double, y double")
    assert spatial.cell_index(polys).count() == 0
    got = spatial.spatial_join(points, polys).select(F.col("id")).collect()
    assert [r[0] for r in got] == []


def test_a_tree_computes_a_feature_once_per_row(spark):
    """Not once per threshold or step: the features may be long expressions."""
    from strata.functions.hashing import hash_unit
    from strata.models import trees
    df = spark.range(40).select("id", (F.col("id") % 2).cast("double").alias("y"), hash_unit("id").alias("x"))

    def optimized(d):
        return d._jdf.queryExecution().optimizedPlan().toString()
    binned = trees._binned(df, ["x"], [[i / 20 for i in range(1, 20)]], F.col("y"))
    assert optimized(binned).count("md5(") == 1 and "lambdafunction" not in optimized(binned)
    x = {r["id"]: r["x"] for r in df.collect()}
    rows = df.select("id", "x", "y")
    got = [r["b"][0] for r in trees._binned(rows.orderBy("id").coalesce(1), ["x"], [[i / 20 for i in range(1, 20)]], F.col("y")).collect()]
    assert got == [sum(x[k] > i / 20 for i in range(1, 20)) for k in sorted(x)]
    tree = [{"p": 0.0, "o": 1, "f": 0, "t": 0.5, "l": 1, "r": 2}, {"p": 0.0}, {"p": 1.0}]
    placed = df.select("id", trees.leaf_of(tree, ["x"]).alias("leaf"))
    plan = optimized(placed)
    assert plan.index("md5(") < plan.index("aggregate(")
    assert {r["id"]: r["leaf"] for r in placed.collect()} == {k: 1 if v <= 0.5 else 2 for k, v in x.items()}


def test_points_of_one_small_split_are_made_by_many_tasks(spark, small_dir):
    from strata.plans.cat_models import _clusters
    assert _clusters(spark, small_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_bitmaps_of_one_split_are_written_by_many_tasks(spark, tmp_path):
    from strata.sources import images
    rows = [(i, 1, 2, bytes([i, 1, 2, 3, 4, 5])) for i in range(40)]
    im = spark.createDataFrame(rows, "img long, height int, width int, data binary").coalesce(1)
    path = images.write_bitmaps(im, str(tmp_path / "b"))
    names = [f.name for f in (tmp_path / "b").glob("img=*/part-*")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 1
    got = images.images_to_pixels(images.read_images(spark, path), r"img=(\d+)/").where("i = 0 and j = 0 and k = 0")
    assert {r["img"]: r["v"] for r in got.collect()} == {i: i for i in range(40)}


def test_fit_inputs_are_dealt_by_rows_whatever_split_they_come_from(spark):
    """One large split among empty ones, and more parts than the rows call for."""
    from strata.models.flows import ensure_parallelism
    cores = spark.sparkContext.defaultParallelism
    want = cores + 3
    one = spark.range(0, 50 * want, 1, 1).union(spark.range(0, 0, 1, cores))
    out = ensure_parallelism(one, rows_per_task=50)
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert len(sizes) == want and sum(sizes) == 50 * want and max(sizes) <= 60
    many = spark.range(0, 100, 1, 4 * cores)
    assert ensure_parallelism(many, rows_per_task=50).rdd.getNumPartitions() == max(cores, 2)


def test_hyper_compare_locates_its_trips_once(spark, small_dir, monkeypatch):
    from strata.plans import cat_models, taxi
    calls, real = [], taxi.taxi_trips
    monkeypatch.setattr(taxi, "taxi_trips", lambda *a: calls.append(a) or real(*a))
    monkeypatch.setattr(cat_models.taxi, "compare_settings", lambda trips, ks: spark.createDataFrame(
        [(k, 0.0, 1.0) for k in ks], "n_clusters int, mae_train double, mae_test double"))
    rows = cat_models.hyper_compare(spark, small_dir).collect()
    assert len(calls) == 1 and all(r["train_better_than_mean"] and r["has_test"] for r in rows)


def test_a_search_computes_its_rows_once(spark):
    """Not again for their number of parts, their count and their use."""
    from strata.models.flows import right_size
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    out = right_size(spark.range(0, 100, 1, 4).mapInArrow(counted, "id long"), rows_per_partition=50)
    assert sorted(r[0] for r in out.collect()) == list(range(100)) and out.rdd.getNumPartitions() == 2
    assert out.count() == 100 and seen.value == 100
    out.unpersist()


def test_bitmaps_in_a_mounted_folder_start_no_process_and_few_tasks_read_them(spark, tmp_path):
    """Hadoop's writer leaves a checksum file beside each file; rows of one id, and an id that is null, each get a file."""
    from strata.sources import images
    rows = [(i, 1, 2, bytes([i, 1, 2, 3, 4, 5])) for i in range(60)] + [(7, 1, 2, bytes(6)), (7, 1, 2, bytes(6)), (None, 1, 2, bytes(6))]
    im = spark.createDataFrame(rows, "img long, height int, width int, data binary").repartition(3)
    path = images.write_bitmaps(im, str(tmp_path / "b"))
    files = [f for f in (tmp_path / "b").rglob("*") if f.is_file()]
    assert len(files) == len(rows) and all(f.name.startswith("part-") for f in files)
    read = images.read_images(spark, path, 4)
    assert read.rdd.getNumPartitions() <= 4
    assert sorted(bytes(r["data"]) for r in read.collect()) == sorted(r[3] for r in rows)
    empty = images.write_bitmaps(im.limit(0), str(tmp_path / "none"))
    assert images.read_images(spark, empty, 4).count() == 0
    by_name = images.write_bitmaps(im.limit(5).withColumn("img", im["img"].cast("string")), str(tmp_path / "s"))
    assert images.read_images(spark, by_name).count() == 5


def test_cluster_features_of_the_duration_flow_are_one_vector(spark, small_dir):
    """No column for each cluster, and the values and predictions of columns (k-means may find fewer centres than asked for)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from strata.models.flows import cluster_feature_stages, duration_flow
    from strata.plans import taxi
    trips = taxi.split_trips(taxi.taxi_trips(spark, small_dir))
    train = trips.where("split = 'train'").persist()
    flow = duration_flow(taxi.LOC, taxi.BASE, "dur", 30, gbt_iter=3)
    got = flow.fit(train).transform(trips)
    assert not [c for c in got.columns if c.startswith("cluster-")]
    plain = Pipeline(stages=cluster_feature_stages(taxi.LOC, 30) + [
        VectorAssembler(inputCols=taxi.BASE + [f"cluster-{i}" for i in range(30)], outputCol="_features"), flow.getStages()[-1]])
    want = {r[0]: r[1:] for r in plain.fit(train).transform(trips).select("id", "_features", "predicted").collect()}
    have = {r[0]: r[1:] for r in got.select("id", "_features", "predicted").collect()}
    train.unpersist()
    def entries(v):
        return {i: x for i, x in enumerate(v.toArray()) if x}
    assert len(have) == trips.count() and all(
        entries(have[i][0]) == entries(want[i][0]) and abs(have[i][1] - want[i][1]) < 1e-9 for i in want)


def test_fits_that_fill_the_cores_run_one_by_one(spark, small_dir, monkeypatch):
    import threading
    import time
    from strata.plans import taxi
    trips = taxi.split_trips(taxi.taxi_trips(spark, small_dir))
    running, most, lock, real = [0], [0], threading.Lock(), taxi.duration_flow

    def flow(loc, base, label, k, seed=1, gbt_iter=20):
        made = real(loc, base, label, k, seed=seed, gbt_iter=1)

        class Watched:
            def fit(self, train):
                with lock:
                    running[0] += 1
                    most[0] = max(most[0], running[0])
                time.sleep(0.5)
                try:
                    return made.fit(train)
                finally:
                    with lock:
                        running[0] -= 1
        return Watched()
    monkeypatch.setattr(taxi, "duration_flow", flow)
    want = taxi.compare_settings(trips, (2, 3)).collect()
    assert most[0] == 2
    most[0] = 0
    many = trips.repartition(2 * spark.sparkContext.defaultParallelism + 1)
    got = taxi.compare_settings(many, (2, 3)).collect()
    assert most[0] == 1 and [r["n_clusters"] for r in got] == [r["n_clusters"] for r in want]
