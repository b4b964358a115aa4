"""Dot products, vector and matrix algebra, point transforms, and the
nearest class-mean classifier's accuracy."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from strata.functions.vectors import dot, vadd, vscale
from strata.operators import matrices as mx
from strata.operators.ordering import train_test_split
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views

DIM = "len(embedding)"
THETA = math.pi / 6
SCALE_Y = 2.0


def _seq_sum(expr_of_i: str) -> str:
    """DuckDB left fold over positions 1..n (same order as Spark's aggregate)."""
    return (f"list_reduce(list_transform(range(1, {DIM} + 1), lambda i: {expr_of_i}), "
            f"lambda a, b: a + b)")


@query("dot_product", f"""
SELECT vec_id AS id,
  round({_seq_sum('embedding[i]::DOUBLE * embedding[i]::DOUBLE')}, 6) AS self_dot,
  round({_seq_sum(f'embedding[i]::DOUBLE * embedding[{DIM} + 1 - i]::DOUBLE')}, 6) AS mirror_dot
FROM embeddings""")
def dot_product(spark, d):
    """Per vector: v . v and v . reverse(v)."""
    v = views.vectors(spark, d)
    return rounded(v.select("id", dot("v", "v").alias("self_dot"),
                            dot("v", F.reverse("v")).alias("mirror_dot")))


@query("vector_add", """
SELECT a.vec_id AS id, CAST(p - 1 AS INTEGER) AS pos,
       round(a.embedding[p]::DOUBLE + b.embedding[p]::DOUBLE, 6) AS value
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1, range(1, len(a.embedding) + 1) t(p)""")
def vector_add(spark, d):
    """Each vector plus its successor (by key), long form."""
    v = views.vectors(spark, d)
    nxt = v.select((F.col("id") - 1).alias("id"), F.col("v").alias("w"))
    s = v.join(nxt, "id").select("id", vadd("v", "w").alias("s"))
    return rounded(mx.explode_vector(s, "id", "s").withColumn("pos", F.col("pos").cast("int")))


@query("vector_scale", """
SELECT vec_id AS id, CAST(p - 1 AS INTEGER) AS pos, round(embedding[p]::DOUBLE * 10.0, 6) AS value
FROM embeddings, range(1, len(embedding) + 1) t(p)""")
def vector_scale(spark, d):
    v = views.vectors(spark, d).select("id", vscale("v", 10.0).alias("s"))
    return rounded(mx.explode_vector(v, "id", "s").withColumn("pos", F.col("pos").cast("int")))


@query("matrix_vector", with_views("""
SELECT m.r, round(sum(m.v * x.x), 6) AS y
FROM matrix m JOIN (SELECT c, avg(v) AS x FROM matrix GROUP BY c) x ON m.c = x.c GROUP BY m.r""", "matrix"))
def matrix_vector(spark, d):
    """Embedding matrix times the mean embedding vector."""
    m = views.matrix(spark, d)
    x = m.groupBy("c").agg(F.avg("v").alias("x"))
    return rounded(mx.matrix_vector(m, x))


@query("matrix_multiply", with_views("""
SELECT a.r, CAST(b.label AS BIGINT) AS c, round(sum(a.v * b.w), 6) AS v
FROM matrix a JOIN (SELECT m.c AS k, e.label, avg(m.v) AS w FROM matrix m JOIN embeddings e ON m.r = e.vec_id
                    GROUP BY m.c, e.label) b ON a.c = b.k
GROUP BY a.r, b.label""", "matrix"))
def matrix_multiply(spark, d):
    """(vectors x dims) times (dims x labels) of per-label mean vectors."""
    m = views.matrix(spark, d)
    labels = views.vectors(spark, d).select(F.col("id").alias("r"), "label")
    b = m.join(labels, "r").groupBy(F.col("c").alias("r"), F.col("label").cast("bigint").alias("c")) \
        .agg(F.avg("v").alias("v"))
    return rounded(mx.matrix_multiply(m, b))


@query("matrix_transpose", with_views("SELECT c AS r, r AS c, round(v, 6) AS v FROM matrix", "matrix"))
def matrix_transpose(spark, d):
    return rounded(mx.transpose(views.matrix(spark, d)))


@query("matrix_row_col", with_views("""
SELECT 'row' AS kind, c AS idx, round(v, 6) AS v FROM matrix WHERE r = (SELECT min(r) FROM matrix)
UNION ALL SELECT 'col', r, round(v, 6) FROM matrix WHERE c = 0""", "matrix"))
def matrix_row_col(spark, d):
    """First row and first column of the matrix, each as (idx, v)."""
    m = views.matrix(spark, d)
    first_r = m.select(F.min("r")).scalar()
    row = m.filter(F.col("r") == first_r).select(F.lit("row").alias("kind"), F.col("c").alias("idx"), "v")
    col = m.filter(F.col("c") == 0).select(F.lit("col").alias("kind"), F.col("r").alias("idx"), "v")
    return rounded(row.unionByName(col))


@query("matrix_from_flat", """
SELECT vec_id AS id, 'row' AS layout, CAST((p - 1) // 8 AS INTEGER) AS r, CAST((p - 1) % 8 AS INTEGER) AS c,
       round(embedding[p]::DOUBLE, 6) AS v FROM embeddings, range(1, len(embedding) + 1) t(p)
UNION ALL
SELECT vec_id, 'col', CAST((p - 1) % 8 AS INTEGER), CAST((p - 1) // 8 AS INTEGER),
       round(embedding[p]::DOUBLE, 6) FROM embeddings, range(1, len(embedding) + 1) t(p)""")
def matrix_from_flat(spark, d):
    """Each 64-long vector as an 8 x 8 matrix in row- and column-major layout."""
    v = views.vectors(spark, d)
    rows = mx.from_flat(v, "id", "v", 8, 8, "row").withColumn("layout", F.lit("row"))
    cols = mx.from_flat(v, "id", "v", 8, 8, "col").withColumn("layout", F.lit("col"))
    return rounded(rows.unionByName(cols).select("id", "layout", "r", "c", "v"))


def _apply_sql(m, x: str, y: str) -> tuple[str, str]:
    return (f"({m[0][0]!r} * {x} + {m[0][1]!r} * {y})", f"({m[1][0]!r} * {x} + {m[1][1]!r} * {y})")


_ROT = mx.rotation(THETA)
_RESC = mx.rescale_y(SCALE_Y)
_RX, _RY = _apply_sql(_ROT, "(plong + 74.0)", "(plat - 40.5)")


@query("rotate_points", with_views(
    f"SELECT id, round({_RX}, 6) AS rx, round({_RY}, 6) AS ry FROM geo", "geo"))
def rotate_points(spark, d):
    """Pickup offsets (from the map origin) rotated by 30 degrees."""
    g = views.geo(spark, d).select("id", (F.col("plong") + 74.0).alias("x"), (F.col("plat") - 40.5).alias("y"))
    return rounded(mx.apply_2x2(g, _ROT, "x", "y", "rx", "ry").select("id", "rx", "ry"))


_RS = mx.compose(_RESC, _ROT)   # rotate, then rescale
_SR = mx.compose(_ROT, _RESC)   # rescale, then rotate
_A = _apply_sql(_RS, "(plong + 74.0)", "(plat - 40.5)")
_B = _apply_sql(_SR, "(plong + 74.0)", "(plat - 40.5)")


@query("compose_transforms", with_views(
    f"SELECT id, round({_A[0]}, 6) AS rs_x, round({_A[1]}, 6) AS rs_y, "
    f"round({_B[0]}, 6) AS sr_x, round({_B[1]}, 6) AS sr_y FROM geo", "geo"))
def compose_transforms(spark, d):
    """Rotation and y-rescale composed in both orders (they differ)."""
    g = views.geo(spark, d).select("id", (F.col("plong") + 74.0).alias("x"), (F.col("plat") - 40.5).alias("y"))
    a = mx.apply_2x2(g, _RS, "x", "y", "rs_x", "rs_y")
    b = mx.apply_2x2(a, _SR, "x", "y", "sr_x", "sr_y")
    return rounded(b.select("id", "rs_x", "rs_y", "sr_x", "sr_y"))


@query("map_vectors", with_views("""
SELECT id, round(plong + 74.0, 6) AS f1_x, round(2.0 * (plat - 40.5), 6) AS f1_y,
       round(plong + 74.0, 6) AS f2_x, round((plat - 40.5) * (plat - 40.5), 6) AS f2_y FROM geo""", "geo"))
def map_vectors(spark, d):
    """Linear f1(x, y) = (x, 2y) and nonlinear f2(x, y) = (x, y^2)."""
    g = views.geo(spark, d).select("id", (F.col("plong") + 74.0).alias("x"), (F.col("plat") - 40.5).alias("y"))
    return rounded(g.select("id", F.col("x").alias("f1_x"), (F.lit(2.0) * F.col("y")).alias("f1_y"),
                            F.col("x").alias("f2_x"), (F.col("y") * F.col("y")).alias("f2_y")))


def _unit(key_sql: str, seed: int = 1) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{seed}'), 1, 13)) AS BIGINT)"
            f" / 4503599627370496.0)")


@query("accuracy", f"""
WITH e AS (SELECT vec_id, label, embedding, {_unit('vec_id')} < 0.7 AS is_train FROM embeddings),
cm AS (SELECT e.label, p, avg(e.embedding[p]::DOUBLE) AS m FROM e, range(1, len(e.embedding) + 1) t(p)
       WHERE is_train GROUP BY e.label, p),
dist AS (SELECT t.vec_id, t.label AS actual, cm.label AS cls,
           sum((t.embedding[cm.p]::DOUBLE - cm.m) * (t.embedding[cm.p]::DOUBLE - cm.m)) AS d2
         FROM e t JOIN cm ON true WHERE NOT t.is_train GROUP BY t.vec_id, t.label, cm.label),
pred AS (SELECT vec_id, actual, cls FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cls) AS rk FROM dist) WHERE rk = 1)
SELECT round(avg(CASE WHEN cls = actual THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n_test FROM pred""")
def accuracy(spark, d):
    """Nearest class-mean classifier: class means from the train split
    (labels x dims, bounded), accuracy on the test split."""
    from strata.operators.spatial import nearest_centre
    v = train_test_split(views.vectors(spark, d), "id", 0.7)
    train = v.filter(F.col("split") == "train")
    test = v.filter(F.col("split") == "test")
    means = train.select("label", F.posexplode("v").alias("p", "x")).groupBy("label", "p") \
        .agg(F.avg("x").alias("m"))
    by_label = {}
    for r in means.collect():   # labels x dims rows: bounded by the label count
        by_label.setdefault(r["label"], {})[r["p"]] = r["m"]
    labels = sorted(by_label)
    centres = [[by_label[lb][p] for p in sorted(by_label[lb])] for lb in labels]
    dims = len(centres[0])
    flat = test.select("id", "label", *[F.col("v")[i].alias(f"_d{i}") for i in range(dims)])
    pred = nearest_centre(flat, centres, [f"_d{i}" for i in range(dims)], out_col="_ci")
    lab = F.array(*[F.lit(x) for x in labels])
    pred = pred.withColumn("predicted", F.element_at(lab, F.col("_ci") + 1))
    return rounded(pred.agg(
        F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test")))
