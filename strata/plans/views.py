"""Derived views on the driver tables, in Spark and as DuckDB SQL.

Each view has a Spark builder ``<name>(spark, data_dir)`` and an SQL text
``VIEW_SQL[name]`` that the oracle queries put in a WITH clause.  Both
compute the same values with the same arithmetic, so results can be
compared exactly after rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.temporal import dow_name, iso_dow, plus_minutes
from strata.sources.tables import table


def _e(i: int):
    """i-th (0-based) embedding element as double."""
    return F.col("embedding")[i].cast("double")


def trips(spark: SparkSession, d: str) -> DataFrame:
    """events as trips: pickup = ts, dropoff = ts + floor(value) minutes."""
    ev = table(spark, d, "events")
    return ev.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("k"),
        F.col("ts").alias("pickup"),
        plus_minutes(F.col("ts"), F.floor(F.col("value"))).alias("dropoff"),
        F.col("value").alias("dur"))


def geo(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as trip end points near New York (degrees)."""
    em = table(spark, d, "embeddings")
    return em.select(
        F.col("vec_id").alias("id"), F.col("label"),
        (F.lit(40.5) + _e(0)).alias("plat"), (F.lit(-74.0) + _e(1)).alias("plong"),
        (F.lit(40.5) + _e(2)).alias("dlat"), (F.lit(-74.0) + _e(3)).alias("dlong"))


def points(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as planar pickup (x, y) and dropoff (x2, y2) points."""
    em = table(spark, d, "embeddings")
    return em.select(
        F.col("vec_id").alias("id"),
        (F.abs(_e(0)) * F.lit(3.0)).alias("x"), (F.abs(_e(1)) * F.lit(3.0)).alias("y"),
        (F.abs(_e(2)) * F.lit(3.0)).alias("x2"), (F.abs(_e(3)) * F.lit(3.0)).alias("y2"))


def _pt(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def areas(spark: SparkSession, d: str) -> DataFrame:
    """Polygons derived from the nation, region and supplier tables.

    nation n: the 0.3-wide square of a 5 x 5 grid (neighbours share edges);
    region r: a diamond of radius 0.3 centred at (0.3 + 0.25 r, 0.3 + 0.25 r)
    with a square hole of half-width 0.08; it overlaps several nations;
    supplier s: a 0.07-wide square at (0.05 (s mod 30), 0.05 floor(s / 30)),
    overlapping its neighbours (their number grows with the data).
    """
    na = table(spark, d, "nation")
    x0 = F.lit(0.3) * (F.col("n_nationkey") % 5)
    y0 = F.lit(0.3) * F.floor(F.col("n_nationkey") / 5)
    x1, y1 = x0 + F.lit(0.3), y0 + F.lit(0.3)
    sq = F.array(F.array(_pt(x0, y0), _pt(x1, y0), _pt(x1, y1), _pt(x0, y1), _pt(x0, y0)))
    nations = na.select((F.col("n_nationkey").cast("bigint")).alias("poly_id"),
                        F.col("n_name").alias("name"), sq.alias("rings"))
    re = table(spark, d, "region")
    c = F.lit(0.3) + F.lit(0.25) * F.col("r_regionkey")
    r, h = F.lit(0.3), F.lit(0.08)
    outer = F.array(_pt(c, c - r), _pt(c + r, c), _pt(c, c + r), _pt(c - r, c), _pt(c, c - r))
    hole = F.array(_pt(c - h, c - h), _pt(c + h, c - h), _pt(c + h, c + h), _pt(c - h, c + h),
                   _pt(c - h, c - h))
    regions = re.select((F.lit(100) + F.col("r_regionkey")).cast("bigint").alias("poly_id"),
                        F.col("r_name").alias("name"), F.array(outer, hole).alias("rings"))
    su = table(spark, d, "supplier")
    sx0 = F.lit(0.05) * (F.col("s_suppkey") % 30)
    sy0 = F.lit(0.05) * F.floor(F.col("s_suppkey") / 30)
    sx1, sy1 = sx0 + F.lit(0.07), sy0 + F.lit(0.07)
    ssq = F.array(F.array(_pt(sx0, sy0), _pt(sx1, sy0), _pt(sx1, sy1), _pt(sx0, sy1), _pt(sx0, sy0)))
    suppliers = su.select((F.lit(1000) + F.col("s_suppkey")).cast("bigint").alias("poly_id"),
                          F.col("s_name").alias("name"), ssq.alias("rings"))
    return nations.unionByName(regions).unionByName(suppliers)


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as 4-channel pixel rows: image = label, row i = vec_id,
    column j = pos div 4, channel k = pos mod 4, v = floor(|e| * 255) in 0..255."""
    em = table(spark, d, "embeddings")
    ex = em.select(F.col("label").alias("img"), F.col("vec_id").alias("i"),
                   F.posexplode("embedding").alias("pos", "e"))
    v = F.least(F.greatest(F.floor(F.abs(F.col("e").cast("double")) * F.lit(255.0)), F.lit(0)), F.lit(255))
    return ex.select("img", "i", (F.col("pos") / 4).cast("int").alias("j"),
                     (F.col("pos") % 4).cast("int").alias("k"), v.cast("int").alias("v"))


def pixel_channels(spark: SparkSession, d: str) -> DataFrame:
    """The pixels with their four channels as one array ``ch``."""
    em = table(spark, d, "embeddings")
    vals = F.transform("embedding", lambda e: F.least(F.greatest(
        F.floor(F.abs(e.cast("double")) * F.lit(255.0)), F.lit(0)), F.lit(255)).cast("int"))
    each = em.select(F.col("label").alias("img"), F.col("vec_id").alias("i"), vals.alias("_all"))
    part = F.transform(F.sequence(F.lit(0), F.expr("size(_all) div 4 - 1").cast("int")),
                       lambda j: F.slice(F.col("_all"), j * 4 + 1, F.lit(4)))
    return each.select("img", "i", F.posexplode(part).alias("j", "ch"))


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """embeddings with the vector as array<double>."""
    em = table(spark, d, "embeddings")
    return em.select(F.col("vec_id").alias("id"), "label",
                     F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def matrix(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as a long-form matrix (r = vec_id, c = position, v)."""
    em = table(spark, d, "embeddings")
    ex = em.select(F.col("vec_id").alias("r"), F.posexplode("embedding").alias("c", "v"))
    return ex.select("r", F.col("c").cast("bigint").alias("c"), F.col("v").cast("double").alias("v"))


def located_trips(spark: SparkSession, d: str) -> DataFrame:
    """trips with end points: each event's user is looked up in the
    embeddings (user_id = vec_id) for planar (x, y, x2, y2) and degree
    (plat, plong, dlat, dlong) coordinates.  Left join: no trip is lost."""
    from strata.operators.joins import lookup_join
    ev = table(spark, d, "events")
    t = ev.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("k"), "user_id",
        F.col("ts").alias("pickup"),
        plus_minutes(F.col("ts"), F.floor(F.col("value"))).alias("dropoff"),
        F.col("value").alias("dur"))
    em = table(spark, d, "embeddings")
    loc = em.select(
        F.col("vec_id").alias("user_id"),
        (F.abs(_e(0)) * F.lit(3.0)).alias("x"), (F.abs(_e(1)) * F.lit(3.0)).alias("y"),
        (F.abs(_e(2)) * F.lit(3.0)).alias("x2"), (F.abs(_e(3)) * F.lit(3.0)).alias("y2"),
        (F.lit(40.5) + _e(0)).alias("plat"), (F.lit(-74.0) + _e(1)).alias("plong"),
        (F.lit(40.5) + _e(2)).alias("dlat"), (F.lit(-74.0) + _e(3)).alias("dlong"))
    return lookup_join(t, loc, "user_id", how="left")


def area_names(spark: SparkSession, d: str) -> DataFrame:
    """Per embedding point: pickup and dropoff area names (sorted, ' | ')."""
    from strata.operators.spatial import polygon_names
    return polygon_names(points(spark, d), areas(spark, d), "id",
                         [("x", "y", "pickup_area"), ("x2", "y2", "dropoff_area")])


def daily(spark: SparkSession, d: str) -> DataFrame:
    """orders counted per calendar day."""
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderdate").cast("date").alias("date")) \
        .agg(F.count(F.lit(1)).alias("n"))


def daily_with_dow(spark: SparkSession, d: str) -> DataFrame:
    return daily(spark, d).withColumns({
        "day_of_week": dow_name(F.col("date")), "dow": iso_dow(F.col("date"))})


def goods(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"),
                     F.col("l_quantity").alias("carat"), F.col("l_returnflag").alias("clarity"))


def carts(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    pa = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    from strata.operators.joins import lookup_join
    j = lookup_join(li, pa, li["l_partkey"] == pa["p_partkey"])
    return j.select(F.col("l_orderkey").alias("cart"), "l_linenumber", F.col("p_name").alias("product"),
                    F.col("p_retailprice").alias("price"), F.col("l_quantity").alias("qty"))


# ---------------------------------------------------------------- SQL forms
VIEW_SQL = {
    "trips": """SELECT event_id AS id, event_type AS k, ts AS pickup,
        ts + to_minutes(CAST(floor(value) AS BIGINT)) AS dropoff, value AS dur FROM events""",
    "geo": """SELECT vec_id AS id, label,
        40.5::DOUBLE + embedding[1]::DOUBLE AS plat, -74.0::DOUBLE + embedding[2]::DOUBLE AS plong,
        40.5::DOUBLE + embedding[3]::DOUBLE AS dlat, -74.0::DOUBLE + embedding[4]::DOUBLE AS dlong
        FROM embeddings""",
    "points": """SELECT vec_id AS id,
        abs(embedding[1]::DOUBLE) * 3.0::DOUBLE AS x, abs(embedding[2]::DOUBLE) * 3.0::DOUBLE AS y,
        abs(embedding[3]::DOUBLE) * 3.0::DOUBLE AS x2, abs(embedding[4]::DOUBLE) * 3.0::DOUBLE AS y2
        FROM embeddings""",
    # edges of the area polygons: one row per (polygon, ring, edge); the
    # edge's start is vertex number ``vertex`` of its ring
    "area_edges": """
        SELECT poly_id, name, ring, vertex, vertex = 3 AS last_edge, x1, y1, x2, y2 FROM (
          SELECT CAST(n_nationkey AS BIGINT) AS poly_id, n_name AS name,
                 0.3::DOUBLE * (n_nationkey % 5) AS x0, 0.3::DOUBLE * floor(n_nationkey / 5) AS y0
          FROM nation) s,
        LATERAL (VALUES (0, 0, x0, y0, x0 + 0.3::DOUBLE, y0),
                        (0, 1, x0 + 0.3::DOUBLE, y0, x0 + 0.3::DOUBLE, y0 + 0.3::DOUBLE),
                        (0, 2, x0 + 0.3::DOUBLE, y0 + 0.3::DOUBLE, x0, y0 + 0.3::DOUBLE),
                        (0, 3, x0, y0 + 0.3::DOUBLE, x0, y0)) e(ring, vertex, x1, y1, x2, y2)
        UNION ALL
        SELECT poly_id, name, ring, vertex, vertex = 3 AS last_edge, x1, y1, x2, y2 FROM (
          SELECT CAST(100 + r_regionkey AS BIGINT) AS poly_id, r_name AS name,
                 0.3::DOUBLE + 0.25::DOUBLE * r_regionkey AS c FROM region) s,
        LATERAL (VALUES (0, 0, c, c - 0.3::DOUBLE, c + 0.3::DOUBLE, c),
                        (0, 1, c + 0.3::DOUBLE, c, c, c + 0.3::DOUBLE),
                        (0, 2, c, c + 0.3::DOUBLE, c - 0.3::DOUBLE, c),
                        (0, 3, c - 0.3::DOUBLE, c, c, c - 0.3::DOUBLE),
                        (1, 0, c - 0.08::DOUBLE, c - 0.08::DOUBLE, c + 0.08::DOUBLE, c - 0.08::DOUBLE),
                        (1, 1, c + 0.08::DOUBLE, c - 0.08::DOUBLE, c + 0.08::DOUBLE, c + 0.08::DOUBLE),
                        (1, 2, c + 0.08::DOUBLE, c + 0.08::DOUBLE, c - 0.08::DOUBLE, c + 0.08::DOUBLE),
                        (1, 3, c - 0.08::DOUBLE, c + 0.08::DOUBLE, c - 0.08::DOUBLE, c - 0.08::DOUBLE))
          e(ring, vertex, x1, y1, x2, y2)
        UNION ALL
        SELECT poly_id, name, ring, vertex, vertex = 3 AS last_edge, x1, y1, x2, y2 FROM (
          SELECT CAST(1000 + s_suppkey AS BIGINT) AS poly_id, s_name AS name,
                 0.05::DOUBLE * (s_suppkey % 30) AS x0, 0.05::DOUBLE * floor(s_suppkey / 30) AS y0
          FROM supplier) s,
        LATERAL (VALUES (0, 0, x0, y0, x0 + 0.07::DOUBLE, y0),
                        (0, 1, x0 + 0.07::DOUBLE, y0, x0 + 0.07::DOUBLE, y0 + 0.07::DOUBLE),
                        (0, 2, x0 + 0.07::DOUBLE, y0 + 0.07::DOUBLE, x0, y0 + 0.07::DOUBLE),
                        (0, 3, x0, y0 + 0.07::DOUBLE, x0, y0)) e(ring, vertex, x1, y1, x2, y2)""",
    "pixels": """SELECT label AS img, vec_id AS i, CAST((p - 1) // 4 AS INTEGER) AS j,
        CAST((p - 1) % 4 AS INTEGER) AS k,
        CAST(least(greatest(floor(abs(embedding[p]::DOUBLE) * 255.0::DOUBLE), 0), 255) AS INTEGER) AS v
        FROM embeddings, range(1, len(embedding) + 1) t(p)""",
    "matrix": """SELECT vec_id AS r, CAST(p - 1 AS BIGINT) AS c, embedding[p]::DOUBLE AS v
        FROM embeddings, range(1, len(embedding) + 1) t(p)""",
    "daily": """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1""",
    "daily_with_dow": """SELECT date, n,
        ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(date)] AS day_of_week,
        CAST(isodow(date) AS INTEGER) AS dow
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)""",
    "goods": """SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS carat,
        l_returnflag AS clarity FROM lineitem""",
    "carts": """SELECT l_orderkey AS cart, l_linenumber, p_name AS product, p_retailprice AS price,
        l_quantity AS qty FROM lineitem JOIN part ON l_partkey = p_partkey""",
}


def with_views(sql: str, *names: str, ctes: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with a WITH clause defining the named views, followed
    by any extra ``name AS (...)`` common table expressions."""
    parts = [f"{n} AS ({VIEW_SQL[n]})" for n in names] + list(ctes)
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql
