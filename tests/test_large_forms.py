"""Operators whose form only matters for large inputs, against plain ones:
selection of quantiles, blocked products, polygons cut into cells."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import aggregates as agg
from strata.operators import matrices as mx
from strata.operators import spatial


def test_quantiles_of_awkward_values(spark):
    """A group of a third of the rows, one value many times, signs, zeros,
    infinities, far magnitudes, subnormals, a null group, NULL values."""
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.normal(size=900) * 10.0 ** rng.integers(-300, 300, 900),
        "one": np.array([5.25]), "two": np.array([-1.0, 3.0]), "same": np.full(300, 7.5),
        "ties": np.concatenate([np.full(500, 2.0), rng.normal(size=100)]),
        "signs": np.array([-3.0, -0.0, 0.0, 5e-324, -5e-324, 1e-310, 2.0, -1e308, 1.7e308]),
        "wide": np.concatenate([[-math.inf], rng.normal(size=50), [math.inf, math.inf]]),
        None: np.round(rng.uniform(0, 100, 777), 2),
    }
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))] for r in agg.exact_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        x = np.sort(x)
        for q, have in zip(probs, got[g]):
            h = (len(x) - 1) * q
            lo, hi = x[math.floor(h)], x[math.ceil(h)]
            want = lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo)
            assert have == want or have == pytest.approx(want, rel=1e-12)
    whole = agg.exact_quantiles(df.where("g = 'hot'"), [], "v", [0.5]).collect()
    assert whole[0]["q0"] == got["hot"][3]
    assert agg.exact_quantiles(df.limit(0), ["g"], "v", [0.5]).collect() == []


def test_quantiles_need_no_sort_of_the_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as v")
    plan = agg.boxplot_stats(df, ["g"], "v")._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()


def test_boxplot_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = {g: np.round(rng.gamma(2.0, 3.0, size=n), 2) for g, n in ((1, 700), (2, 90), (None, 40))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in x.items() for v in vs], "g int, v double")
    for r in agg.boxplot_stats(df, ["g"], "v").collect():
        v = x[r["g"]]
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= r["q1"] - 1.5 * (r["q3"] - r["q1"])) & (v <= r["q3"] + 1.5 * (r["q3"] - r["q1"]))]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["whisker_lo"], r["whisker_hi"]) == (inside.min(), inside.max())
        assert (r["n"], r["n_outliers"]) == (len(v), len(v) - len(inside))


@pytest.mark.parametrize("block", [1, 4, 32])
def test_blocked_product_is_the_entry_join(spark, block):
    """Missing, zero, NULL, repeated entries; negative and long indices."""
    rnd = random.Random(block)
    far = 9_007_199_254_740_993
    a = [(r * 7 - 20, far + c, float(rnd.randint(-3, 3))) for r in range(9) for c in range(37) if rnd.random() < 0.6]
    b = [(far + r, c - 50, float(rnd.randint(-3, 3))) for r in range(41) for c in range(70) if rnd.random() < 0.3]
    a += a[:5] + [(1000, far, None), (1001, far + 400, 1.0)]
    b += b[:3]
    schema = "r long, c long, v double"
    got = mx.matrix_multiply(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), block).collect()
    want: dict = {}
    for r, k, v in a:
        for k2, c, w in b:
            if k == k2 and v is not None:
                want[r, c] = want.get((r, c), 0.0) + v * w
    assert {(r["r"], r["c"]): r["v"] for r in got} == want and len(got) == len(want)
    assert mx.matrix_multiply(spark.createDataFrame(a, schema), spark.createDataFrame([], schema), block).count() == 0


def test_blocked_product_shuffles_partial_sums_not_products(spark):
    n = 96
    m = spark.range(n * n).selectExpr("id div 96 as r", "id % 96 as c", "1.0D as v")
    plan = mx.matrix_multiply(m, m)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    assert {r["v"] for r in mx.matrix_multiply(m, m).collect()} == {float(n)}


def _inside(px, py, edges):
    """Closed even-odd containment with the float formulas of the exact test."""
    x1, y1, x2, y2 = edges.T
    s = (px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)
    on = (s == 0) & (px >= np.minimum(x1, x2)) & (px <= np.maximum(x1, x2)) & (py >= np.minimum(y1, y2)) & (py <= np.maximum(y1, y2))
    return bool(on.any() or ((((y1 > py) != (y2 > py)) & (s * np.sign(y2 - y1) < 0)).sum() % 2))


def _polygons(spark, rows):
    schema = "poly_id long, name string, rings array<array<struct<x:double,y:double>>>"
    return spark.createDataFrame([(i, f"p{i}", [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings])
                                  for i, rings in rows], schema)


def _edges(rings):
    return np.array([[*p, *q] for r in rings for p, q in zip(r, r[1:])], float)


def _closed(points):
    return points + points[:1]


@pytest.mark.parametrize("most", [16])
def test_cells_of_polygons_with_many_edges(spark, monkeypatch, most):
    """A star of 1,500 edges, combs with vertices on cell borders, crossing
    and repeated edges, holes, long thin edges, one vertex of many edges."""
    rnd = random.Random(most)
    star = [(1000 + math.cos(t * math.tau / 1500) * (50 + 20 * math.sin(t * math.tau / 60)) * (1 + rnd.random() / 50),
             -500 + math.sin(t * math.tau / 1500) * 60) for t in range(1500)]
    comb = [(0, 0)] + [p for i in range(32) for p in ((i, 8), (i + 0.5, 1))] + [(32, 8), (32, 0)]
    hub = [p for i in range(40) for p in ((2.0, 2.0), (2 + 3 * math.cos(i / 7), 2 + 3 * math.sin(i / 7)),
                                          (2 + 3 * math.cos(i / 7 + 0.05), 2 + 3 * math.sin(i / 7 + 0.05)))]
    needles = [p for i in range(50) for p in ((0.0, i / 3), (1000.0, i / 3 + rnd.random()))]
    mess = [(rnd.randint(-8, 8), rnd.randint(-8, 8)) for _ in range(120)]
    shapes = [(1, [_closed(star)]), (2, [_closed(comb)]), (3, [_closed(hub)]), (4, [_closed(needles)]), (5, [_closed(mess)]),
              (6, [_closed([(0, 0), (16, 0), (16, 16), (0, 16)]), _closed([(4, 4), (4, 12), (12, 12), (12, 4)])]),
              (7, [_closed([(3, 3), (3, 3), (3, 3)])]), (8, [_closed([(1, 1), (9, 1)])])]
    points = [(rnd.uniform(-10, 40), rnd.uniform(-10, 20)) for _ in range(300)]
    points += [(rnd.uniform(920, 1080), rnd.uniform(-570, -430)) for _ in range(300)]
    points += [(rnd.uniform(0, 1000), rnd.uniform(-1, 18)) for _ in range(100)]
    points += [(x / 2, y / 2) for x in range(-16, 70) for y in range(-16, 18, 3)]
    points += [p for _, rings in shapes for r in rings for p in r[:40]]
    points += [((p[0] + q[0]) / 2, (p[1] + q[1]) / 2) for _, rings in shapes for r in rings for p, q in list(zip(r, r[1:]))[:20]]
    monkeypatch.setattr(spatial, "EDGES", most)
    polys = _polygons(spark, shapes)
    monkeypatch.setattr(spatial, "cell_index", lambda p, f=spatial.cell_index: f(p, most))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    got = {(r["id"], r["poly_id"]) for r in spatial.spatial_join(df, polys).collect()}
    want = {(i, k) for k, rings in shapes for e in [_edges(rings)] for i, (x, y) in enumerate(points) if _inside(x, y, e)}
    assert got == want


def test_a_cell_holds_few_edges_whatever_the_polygon(spark):
    n = 20_000
    ring = _closed([(math.cos(t * math.tau / n), math.sin(t * math.tau / n)) for t in range(n)])
    cells = spatial.cell_index(_polygons(spark, [(1, [ring])]))
    most, rows, inner = cells.agg(F.max(F.size("_edges")), F.count("*"),
                                  F.count_if((F.size("_edges") == 0) & F.col("_inside"))).first()
    assert most <= spatial.EDGES and inner > 100 and rows < n


def test_degenerate_and_tiny_polygons_far_out(spark):
    """Coordinates above 10^7: points, slivers and squares near the resolution."""
    shapes, points = [], []
    for i, (x, y, s) in enumerate([(1e7, 3e7, 0.0), (-4e7 - 1 / 3, 2.5e7, 1e-7), (1e8 + 0.5, -1e8, 2.0 ** -26), (3e12, 1e9, 0.001)]):
        shapes.append((i, [_closed([(x, y), (x + s, y), (x + s, y + s), (x, y + s)])]))
        points += [(x, y), (x + s, y + s), (x + s / 2, y + s / 2), (x - 1e-3, y), (x, y + 1)]
    shapes.append((9, [_closed([(2e7, 2e7), (2e7 + 100, 2e7)])]))
    points += [(2e7 + 50, 2e7), (2e7 + 50, 2e7 + 1e-6), (2e7 + 101, 2e7)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    got = {(r["id"], r["poly_id"]) for r in spatial.spatial_join(df, _polygons(spark, shapes)).collect()}
    assert got == {(i, k) for k, rings in shapes for e in [_edges(rings)] for i, (x, y) in enumerate(points) if _inside(x, y, e)}
