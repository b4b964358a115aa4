"""Linear-algebra laws and the small published examples (vectors, carts)."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import matrices as mx
from strata.operators.joins import lookup_join

finite = st.floats(min_value=-1e3, max_value=1e3, allow_nan=False)


def f1(df, x, y, ox, oy):
    return mx.apply_2x2(df, [[1.0, 0.0], [0.0, 2.0]], x, y, ox, oy)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(finite, finite, finite, finite), min_size=1, max_size=8), finite)
def test_linear_map_laws(spark, rows, c):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, ax double, ay double, bx double, by double")
    df = df.withColumns({"sx": F.col("ax") + F.col("bx"), "sy": F.col("ay") + F.col("by"),
                         "cx": F.lit(c) * F.col("ax"), "cy": F.lit(c) * F.col("ay")})
    out = f1(f1(f1(f1(df, "sx", "sy", "fs_x", "fs_y"), "ax", "ay", "fa_x", "fa_y"),
                "bx", "by", "fb_x", "fb_y"), "cx", "cy", "fc_x", "fc_y").collect()
    for r in out:
        assert r["fs_x"] == pytest.approx(r["fa_x"] + r["fb_x"], abs=1e-9)
        assert r["fs_y"] == pytest.approx(r["fa_y"] + r["fb_y"], abs=1e-9)
        assert r["fc_x"] == pytest.approx(c * r["fa_x"], rel=1e-12, abs=1e-9)
        assert r["fc_y"] == pytest.approx(c * r["fa_y"], rel=1e-12, abs=1e-9)


def test_composition_law(spark):
    rot, resc = mx.rotation(math.pi / 5), mx.rescale_y(3.0)
    df = spark.createDataFrame([(1.0, 2.0), (-3.0, 0.5), (0.0, 0.0)], "x double, y double")
    one = mx.apply_2x2(df, mx.compose(resc, rot), "x", "y", "ox", "oy")
    two = mx.apply_2x2(mx.apply_2x2(df, rot, "x", "y", "tx", "ty"), resc, "tx", "ty", "ox2", "oy2")
    for r in two.join(one, ["x", "y"]).collect():
        assert r["ox"] == pytest.approx(r["ox2"], abs=1e-12)
        assert r["oy"] == pytest.approx(r["oy2"], abs=1e-12)


def test_matrix_examples(spark):
    m1 = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0), (2, 0, 5.0), (2, 1, 6.0)],
                               "r long, c long, v double")
    v1 = spark.createDataFrame([(0, 1.0), (1, 2.0)], "c long, x double")
    y = {r["r"]: r["y"] for r in mx.matrix_vector(m1, v1).collect()}
    assert y == {0: 5.0, 1: 11.0, 2: 17.0}
    m = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "r long, c long, v double")
    for vec, want in [((1, 0), (1.0, 3.0)), ((0, 1), (2.0, 4.0)), ((10, 100), (210.0, 430.0))]:
        x = spark.createDataFrame([(0, float(vec[0])), (1, float(vec[1]))], "c long, x double")
        got = {r["r"]: r["y"] for r in mx.matrix_vector(m, x).collect()}
        assert (got[0], got[1]) == want
    # (m m) v == m (m v)
    mm = mx.matrix_multiply(m, m)
    x = spark.createDataFrame([(0, 10.0), (1, 100.0)], "c long, x double")
    left = {r["r"]: r["y"] for r in mx.matrix_vector(mm, x).collect()}
    mv = mx.matrix_vector(m, x).select(F.col("r").alias("c"), F.col("y").alias("x"))
    right = {r["r"]: r["y"] for r in mx.matrix_vector(m, mv).collect()}
    assert left == right


def test_cart_totals(spark):
    prices = spark.createDataFrame([("banana", 1.3), ("mango", 2.0), ("pineapple", 1.9), ("pears", 1.8)],
                                   "product string, price double")
    carts = spark.createDataFrame([(1, "banana", 10.0), (1, "pineapple", 7.0), (1, "pears", 3.0),
                                   (2, "pineapple", 3.0), (2, "mango", 9.0)], "cart int, product string, qty double")
    j = lookup_join(carts, prices, "product")
    amount = F.col("price").cast("decimal(15,2)") * F.col("qty").cast("decimal(15,2)")
    tot = {r["cart"]: float(r["total"]) for r in j.rollup("cart").agg(F.sum(amount).alias("total")).collect()}
    assert tot == {1: 31.7, 2: 23.7, None: 55.4}


def test_ols_on_dummies_is_group_means(spark):
    from strata.models.learn import fit_ols
    from strata.models.features import one_hot
    rows = [("Mon", 10.0), ("Mon", 12.0), ("Tue", 20.0), ("Tue", 24.0), ("Wed", 7.0)]
    df = one_hot(spark.createDataFrame(rows, "day string, n double"), "day", ["Mon", "Tue", "Wed"], drop_source=False)
    model = fit_ols(df, "n", ["day-Tue", "day-Wed"])
    assert model.intercept == pytest.approx(11.0)
    assert list(model.coefficients) == pytest.approx([11.0, -4.0])


def test_grid_slices_published(spark):
    """The 4 x 2 x 3 grid i + 10 j + 100 k and its published slices."""
    from strata.operators import pixels as px
    from strata.sources.generators import grid
    g = grid(spark, [4, 2, 3], lambda i, j, k: i + 10 * j + 100 * k).withColumnRenamed("value", "v") \
        .withColumn("img", F.lit(0))
    two = {(r["i"], r["j"]): list(r["values"]) for r in px.slice_leading(g, 2).collect()}
    assert [two[(i, j)] for i in range(4) for j in range(2)][:6] == [
        [0, 100, 200], [10, 110, 210], [1, 101, 201], [11, 111, 211], [2, 102, 202], [12, 112, 212]]
    one = {r["i"]: list(r["values"]) for r in px.slice_leading(g, 1).collect()}
    assert one[3] == [3, 103, 203, 13, 113, 213]
    right = sorted((r["i"], r["j"], r["v"]) for r in g.filter(F.col("k") == 0).collect())
    assert [v for _, _, v in right] == [0, 10, 1, 11, 2, 12, 3, 13]


def test_matrix_product_keeps_zeros_and_long_indices(spark):
    import random
    rnd = random.Random(2)
    far = 5_000_000_000_000
    a = {(far + r, c): float(rnd.randint(-2, 2)) for r in range(7) for c in range(5)}
    b = {(r, c - far): float(rnd.randint(-2, 2)) for r in range(5) for c in range(4)}
    schema = "r long, c long, v double"
    got = mx.matrix_multiply(spark.createDataFrame([(*k, v) for k, v in a.items()], schema),
                             spark.createDataFrame([(*k, v) for k, v in b.items()], schema)).collect()
    want = {(far + r, c - far): sum(a[far + r, k] * b[k, c - far] for k in range(5)) for r in range(7) for c in range(4)}
    assert {(r["r"], r["c"]): r["v"] for r in got} == want and 0.0 in want.values()


def test_dot_product_examples_and_additivity(spark):
    from strata.functions.vectors import dot, vadd
    prices = [1.3, 2.0, 1.9, 1.8]          # banana, mango, pineapple, pears
    rows = [([10.0, 0.0, 7.0, 3.0], [0.0, 9.0, 3.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>") \
        .withColumn("p", F.array(*[F.lit(x) for x in prices]))
    r = df.select(dot("p", "a").alias("fa"), dot("p", "b").alias("fb"),
                  dot("p", vadd("a", "b")).alias("fab")).first()
    assert r["fa"] == pytest.approx(31.7) and r["fb"] == pytest.approx(23.7)
    assert r["fab"] == pytest.approx(r["fa"] + r["fb"]) and r["fab"] == pytest.approx(55.4)
    small = spark.range(1).select(
        dot(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.array(F.lit(1.0), F.lit(10.0), F.lit(100.0))).alias("x"),
        dot(F.array(F.lit(4.0), F.lit(-4.0), F.lit(0.0)), F.array(*[F.lit(1 / 3)] * 3)).alias("y")).first()
    assert small["x"] == 321.0 and small["y"] == pytest.approx(0.0, abs=1e-12)
