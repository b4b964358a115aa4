"""Edge cases of the hand-written operators (FIXTURES.md section D)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from strata.functions.geo import lcc_project
from strata.functions.temporal import iso_dow
from strata.functions.text import parse_experience, set_contains, split_to_set
from strata.models.features import one_hot_range
from strata.operators import aggregates as agg
from strata.operators import ordering, spatial
from strata.operators.windows import lookback_events, rolling_lookback, time_line

T = dt.datetime(2024, 1, 1, 12, 0, 0)
H = dt.timedelta(hours=1)
US = dt.timedelta(microseconds=1)
OLD = dt.datetime(2023, 6, 1)


@pytest.fixture(scope="module")
def trips(spark):
    rows = [  # id, k, pickup, dropoff, dur
        (1, "a", T, T + 10 * H, 100.0),             # the probe
        (2, "a", OLD, T, 1.0),                      # dropoff exactly at t: in
        (3, "a", OLD, T - 3 * H, 2.0),              # exactly t - 3h: in
        (4, "a", OLD, T - 3 * H - US, 4.0),         # 1 us too early: out
        (5, "a", OLD, T - H, 8.0),                  # two facts at one instant
        (6, "a", OLD, T - H, 16.0),
        (7, "b", OLD, T - H, 32.0),                 # other key
    ]
    return spark.createDataFrame(rows, "id long, k string, pickup timestamp_ntz, dropoff timestamp_ntz, dur double")


@pytest.mark.parametrize("partitions", [1, 3, 40])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_rolling_window_edges(trips, partitions, keys):
    out = {r["id"]: r for r in rolling_lookback(trips, "id", "pickup", "dropoff", "dur", hours=3, keys=keys,
                                                 partitions=partitions).collect()}
    probe = out[1]
    expect = [1.0, 2.0, 8.0, 16.0] + ([] if keys else [32.0])
    assert probe["n_in_window"] == len(expect)
    assert float(probe["mean_value"]) == pytest.approx(sum(expect) / len(expect))
    for i in range(2, 8):       # probes whose window holds nothing
        assert out[i]["n_in_window"] == 0 and out[i]["mean_value"] is None


@pytest.fixture(scope="module")
def skewed_trips():
    """One key, and one instant in it, hold more than a third of the rows; null keys and times."""
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        p = T + dt.timedelta(minutes=rnd.randint(0, 60 * 48))
        k = "hot" if i % 3 else rnd.choice(["x", "y", None])
        d = T + 20 * H if i % 5 < 2 else p + dt.timedelta(seconds=rnd.randint(0, 18000))
        rows.append((i, k, None if i % 97 == 0 else p, None if i % 89 == 0 else d, float(rnd.randint(1, 9999)) / 100))
    return rows


@pytest.mark.parametrize("partitions", [1, 13, 60])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_lookback_against_all_pairs(spark, skewed_trips, keys, partitions):
    df = spark.createDataFrame(skewed_trips, "id long, k string, pickup timestamp_ntz, dropoff timestamp_ntz, dur double")
    want = {}
    for i, k, p, _, _ in skewed_trips:
        hit = [(f[3], f[4]) for f in skewed_trips if p is not None and f[3] is not None and (not keys or f[1] == k)
               and p - 3 * H <= f[3] <= p]
        want[i] = (len(hit), min((t for t, _ in hit), default=None), max((t for t, _ in hit), default=None),
                   round(sum(v for _, v in hit), 2))
    got = lookback_events(df, "id", "pickup", "dropoff", 3, keys=keys, partitions=partitions).collect()
    assert {r["id"]: (r["n_facts"], r["first_fact"], r["last_fact"]) for r in got} == {i: w[:3] for i, w in want.items()}
    mean = rolling_lookback(df, "id", "pickup", "dropoff", "dur", keys=keys, decimal_scale=2, partitions=partitions)
    for r in mean.collect():
        n, _, _, total = want[r["id"]]
        assert r["n_in_window"] == n
        assert (r["mean_value"] is None) if n == 0 else float(r["mean_value"]) == pytest.approx(total / n)


def _square(x0, y0, s):
    return [(x0, y0), (x0 + s, y0), (x0 + s, y0 + s), (x0, y0 + s), (x0, y0)]


@pytest.fixture(scope="module")
def polys(spark):
    def ring(pts):
        return [{"x": float(x), "y": float(y)} for x, y in pts]
    rows = [
        (1, "B", [ring(_square(0, 0, 4))]),
        (2, "A", [ring(_square(2, 2, 4))]),                              # overlaps B
        (3, "H", [ring(_square(10, 0, 4)), ring(_square(11, 1, 2))]),    # with a hole
    ]
    return spark.createDataFrame(rows, "poly_id long, name string, rings array<array<struct<x:double,y:double>>>")


def test_point_in_polygon_cases(spark, polys):
    pts = [(1, 1.0, 1.0), (2, 20.0, 20.0), (3, 4.0, 1.0), (4, 4.0, 4.0), (5, 3.0, 3.0),
           (6, 12.0, 2.0), (7, None, None), (8, 10.5, 3.0), (9, 11.0, 1.5)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r["id"]: r["names"] for r in spatial.polygon_names(df, polys, "id").collect()}
    assert got == {1: "B", 2: "", 3: "B", 4: "A | B", 5: "A | B", 6: "", 7: None, 8: "H", 9: "H"}


def test_spatial_join_brute_force(spark, polys):
    import random
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-1, 15), rnd.uniform(-1, 7)) for i in range(400)]
    pts += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (4, 2), (2, 4), (11, 2), (13, 3)])]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {(r["id"], r["poly_id"]) for r in spatial.spatial_join(df, polys).collect()}
    rings = {1: [_square(0, 0, 4)], 2: [_square(2, 2, 4)], 3: [_square(10, 0, 4), _square(11, 1, 2)]}

    def inside(px, py, rs):
        odd, on = False, False
        for r in rs:
            for (x1, y1), (x2, y2) in zip(r, r[1:]):
                if (min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2)
                        and (px - x1) * (y2 - y1) == (py - y1) * (x2 - x1)):
                    on = True
                if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                    odd = not odd
        return on or odd
    want = {(i, pid) for i, x, y in pts for pid, rs in rings.items() if inside(x, y, rs)}
    assert got == want


def test_one_hot_fixed_vocabulary(spark):
    df = spark.createDataFrame([(0,), (2,)], "cluster int")
    out = one_hot_range(df, "cluster", 4, drop_source=False)
    assert out.columns == ["cluster", "cluster-0", "cluster-1", "cluster-2", "cluster-3"]
    rows = out.orderBy("cluster").collect()
    assert [r["cluster-1"] for r in rows] == [0.0, 0.0]
    assert [r["cluster-3"] for r in rows] == [0.0, 0.0]


def test_sets_and_flags(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "R"), (4, "R;Clojure;R")], "id int, s string")
    out = df.select("id", split_to_set("s").alias("set")).withColumn("r", set_contains("set", "R")) \
        .withColumn("clj", set_contains("set", "Clojure")).orderBy("id").collect()
    assert [sorted(r["set"]) for r in out] == [[], [""], ["R"], ["Clojure", "R"]]
    assert [r["r"] for r in out] == [False, False, True, True]
    assert [r["clj"] for r in out] == [False, False, False, True]


def test_parse_experience(spark):
    df = spark.createDataFrame([(1, None), (2, "Less than 1 year"), (3, "More than 50 years"), (4, "7"),
                                (5, "abc")], "id int, s string")
    got = [r[0] for r in df.orderBy("id").select(parse_experience("s")).collect()]
    assert got == [None, 0.5, 51.0, 7.0, None]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    h = {r["bin"]: r["n"] for r in agg.histogram(df, "v", 10).collect()}
    assert h == {0: 1, 5: 1, 9: 1}          # the maximum falls in the last bin
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in agg.histogram(const, "v", 10).collect()] == [(0, 2)]


def test_folds_and_split(spark):
    keys = spark.range(800).withColumnRenamed("id", "key")
    f = ordering.kfold_assign(keys, "key", k=20).collect()
    assert sorted(r["key"] for r in f) == list(range(800))
    sizes = {}
    for r in f:
        sizes[r["fold"]] = sizes.get(r["fold"], 0) + 1
    assert set(sizes) == set(range(20)) and max(sizes.values()) - min(sizes.values()) <= 1
    s = ordering.train_test_split(keys, "key", 0.7).groupBy("split").count().collect()
    n = {r["split"]: r["count"] for r in s}
    assert n["train"] + n["test"] == 800 and 480 < n["train"] < 640


def test_positions_with_a_hot_group(spark):
    rows = [(0 if i % 3 else 1, i, float(i % 17)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, key long, v double")
    out = ordering.positions(df, ["v", "key"], group_cols=["g"], buckets=6, size_col="n").collect()
    for g in (0, 1):
        mine = sorted((r["v"], r["key"], r["pos"], r["n"]) for r in out if r["g"] == g)
        assert [m[2] for m in mine] == list(range(len(mine)))
        assert all(m[3] == len(mine) for m in mine)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(1).normal(size=501)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vals)], "g int, v double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in agg.exact_quantiles(df, ["g"], "v", [0.25, 0.9]).collect()}
    for g in (0, 1):
        sub = np.array([v for i, v in enumerate(vals) if i % 2 == g])
        assert got[g][0] == pytest.approx(np.quantile(sub, 0.25))
        assert got[g][1] == pytest.approx(np.quantile(sub, 0.9))


@pytest.mark.parametrize("lat,lon,x,y", [
    (40.47, -74.26, 911908.37699881, 110617.87078182),
    (41.3, -71.8, 1588713.88595833, 420506.52709693),
    (40.885, -73.03, 1252460.55256480, 263192.27520000),
])
def test_projection(spark, lat, lon, x, y):
    px, py = lcc_project(F.lit(lat), F.lit(lon))
    r = spark.range(1).select(px.alias("x"), py.alias("y")).first()
    assert r["x"] == pytest.approx(x, abs=1e-4) and r["y"] == pytest.approx(y, abs=1e-4)


def test_weekday_and_log(spark):
    r = spark.range(1).select(iso_dow(F.lit(dt.date(2013, 1, 1))).alias("d"),
                              F.when(F.lit(0.0) > 0, F.ln(F.lit(0.0))).alias("l0"),
                              F.when(F.lit(-1.0) > 0, F.ln(F.lit(-1.0))).alias("ln")).first()
    assert r["d"] == 2 and r["l0"] is None and r["ln"] is None
    assert math.isclose(spark.range(1).select(F.ln(F.lit(math.e))).first()[0], 1.0)


def test_time_line_stays_balanced(spark):
    """One key, and one instant in it, hold a third of the rows and one date
    lies far from the others: still no partition is twice the median."""
    import random
    rnd = random.Random(5)
    rows = [(-1, "hot", dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2), 1.0)]
    for i in range(12_000):
        k = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        p = T + dt.timedelta(seconds=rnd.randint(0, 3 * 24 * 3600))
        d = T + 20 * H if i % 3 == 1 else p + dt.timedelta(minutes=rnd.randint(0, 200))
        rows.append((i, k, p, d, float(rnd.randint(1, 9999)) / 100))
    df = spark.createDataFrame(rows, "id long, k string, pickup timestamp_ntz, dropoff timestamp_ntz, dur double").repartition(4)
    for keys in ([], ["k"]):
        line = time_line(df, "id", keys, "pickup", "dropoff", F.col("dur").cast("decimal(28,2)"), 3, 20)
        sizes = sorted(r["count"] for r in line.groupBy("_part").count().collect())
        assert sum(sizes) == 3 * len(rows) and len(sizes) >= 18
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        many = rolling_lookback(df, "id", "pickup", "dropoff", "dur", keys=keys, partitions=20, decimal_scale=2).collect()
        one = rolling_lookback(df, "id", "pickup", "dropoff", "dur", keys=keys, partitions=1, decimal_scale=2).collect()
        assert sorted(map(repr, many)) == sorted(map(repr, one)) and len(many) == len(rows)


def test_sample_n_large_path_equals_small_path(spark, monkeypatch):
    df = spark.range(5000).withColumnRenamed("id", "key")
    small = {r["key"] for r in ordering.sample_n(df, 700, "key", seed=3).collect()}
    monkeypatch.setattr(ordering, "TAKE_ORDERED_MAX", 10)
    large = {r["key"] for r in ordering.sample_n(df, 700, "key", seed=3).collect()}
    assert small == large and len(small) == 700


def test_positions_ties_nulls_and_strings(spark):
    """Descending string order with a dominant tied value and NULLs (last),
    ties broken by key; equals a plain sort."""
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(2000):
        s = "hot" if i % 3 else rnd.choice(["a", "é", "zz", None, "b"])
        rows.append((i, s))
    df = spark.createDataFrame(rows, "key long, s string")
    got = {r["key"]: r["pos"] for r in ordering.positions(df, [("s", "desc"), "key"], buckets=7).collect()}
    nonnull = sorted([r for r in rows if r[1] is not None], key=lambda r: (r[1], -r[0]), reverse=True)
    want_order = nonnull + sorted([r for r in rows if r[1] is None], key=lambda r: r[0])
    assert [got[k] for k, _ in want_order] == list(range(len(rows)))
    # groups, with nulls as one of them
    got = {r["key"]: (r["pos"], r["n"]) for r in ordering.positions(
        df, [("key", "desc")], group_cols=["s"], buckets=5, size_col="n").collect()}
    for s in {s for _, s in rows}:
        keys = sorted((k for k, v in rows if v == s), reverse=True)
        assert [got[k] for k in keys] == [(i, len(keys)) for i in range(len(keys))]


def test_attach_by_position_of_unequal_lengths_is_an_error(spark):
    from strata.operators.verbs import zip_by_position
    a, b = spark.range(5).withColumnRenamed("id", "pos"), spark.range(3).selectExpr("id as pos", "id * 2 as v")
    with pytest.raises(Exception, match="unequal length"):
        zip_by_position(a, b, "pos").collect()
    assert zip_by_position(a.limit(0), b.limit(0), "pos").collect() == []


def test_spatial_join_in_feet_and_at_all_scales(spark):
    """Projected coordinates, one polygon over everything, and ones a millionth as wide."""
    import random
    rnd = random.Random(9)

    def ring(pts):
        return [{"x": float(x), "y": float(y)} for x, y in pts]
    sizes = [(1, 900_000.0, 150_000.0, 400_000.0)] + [
        (i, 980_000 + rnd.uniform(0, 60_000), 180_000 + rnd.uniform(0, 60_000), 10 ** rnd.uniform(-1, 4)) for i in range(2, 60)]
    polys = spark.createDataFrame([(i, f"z{i}", [ring(_square(x, y, s))]) for i, x, y, s in sizes],
                                  "poly_id long, name string, rings array<array<struct<x:double,y:double>>>")
    pts = [(i, x + s / 2, y + s / 3) for i, x, y, s in sizes] + [
        (100 + i, 980_000 + rnd.uniform(0, 60_000), 180_000 + rnd.uniform(0, 60_000)) for i in range(300)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {(r["id"], r["poly_id"]) for r in spatial.spatial_join(df, polys).collect()}
    assert got == {(p, i) for p, px, py in pts for i, x, y, s in sizes if x <= px <= x + s and y <= py <= y + s}
    assert spatial.spatial_join(df, polys.limit(0)).count() == 0
    both = spatial.polygon_names(df.selectExpr("id", "x", "y", "x + 1e9 as far", "y as y2"), polys, "id",
                                 [("x", "y", "here"), ("far", "y2", "there")])
    assert all(r["there"] == "" and "z1" in r["here"].split(" | ") for r in both.collect())


def test_boxplot_approx_close_to_exact(spark):
    import numpy as np
    vals = np.random.default_rng(4).gamma(2.0, 3.0, size=4000)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(vals)], "g int, v double")
    ex = {r["g"]: r for r in agg.boxplot_stats(df, ["g"], "v").collect()}
    ap = {r["g"]: r for r in agg.boxplot_stats(df, ["g"], "v", exact=False).collect()}
    for g in (0, 1, 2):
        for c in ("q1", "median", "q3"):
            assert abs(ex[g][c] - ap[g][c]) < 0.05 * (ex[g]["q3"] - ex[g]["q1"])
        assert ex[g]["n"] == ap[g]["n"]


def test_xxhash_method_gives_valid_folds_and_samples(spark):
    keys = spark.range(1000).withColumnRenamed("id", "key")
    f = ordering.kfold_assign(keys, "key", k=10, method="xxhash64").groupBy("fold").count().collect()
    assert sorted(r["count"] for r in f) == [100] * 10
    small = {r["key"] for r in ordering.sample_n(keys, 50, "key", seed=2, method="xxhash64").collect()}
    pos = ordering.shuffle_positions(keys, "key", seed=2, method="xxhash64").filter(F.col("shuffle_pos") < 50)
    assert small == {r["key"] for r in pos.collect()} and len(small) == 50
