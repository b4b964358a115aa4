"""Great-circle and planar distance, projection, polygons and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.geo import haversine, lcc_project, planar_distance, project_rings
from strata.operators import ordering, spatial
from strata.plans import views
from strata.plans.registry import query, rounded
from strata.plans.views import with_views

K_CENTRES = 8


@query("haversine_km", with_views("""
SELECT id, round(2.0 * 6371.0 * asin(sqrt(
    sin((radians(dlat) - radians(plat)) / 2) * sin((radians(dlat) - radians(plat)) / 2)
  + cos(radians(plat)) * cos(radians(dlat))
    * (sin((radians(dlong) - radians(plong)) / 2) * sin((radians(dlong) - radians(plong)) / 2)))), 6)
  AS dist_km FROM geo""", "geo"))
def haversine_km(spark, d):
    g = views.geo(spark, d)
    return rounded(g.select("id", haversine("plat", "plong", "dlat", "dlong").alias("dist_km")))


@query("topk_distance", with_views("""
SELECT id, round(dist_km, 6) AS dist_km FROM (
SELECT id, 2.0 * 6371.0 * asin(sqrt(
    sin((radians(dlat) - radians(plat)) / 2) * sin((radians(dlat) - radians(plat)) / 2)
  + cos(radians(plat)) * cos(radians(dlat))
    * (sin((radians(dlong) - radians(plong)) / 2) * sin((radians(dlong) - radians(plong)) / 2))))
  AS dist_km FROM geo) ORDER BY dist_km DESC, id LIMIT 5""", "geo"))
def topk_distance(spark, d):
    g = views.geo(spark, d).select("id", haversine("plat", "plong", "dlat", "dlong").alias("dist_km"))
    return rounded(ordering.top_k(g, "dist_km", 5, tie_break="id"))


def _lcc_sql(lat: str, lon: str) -> tuple[str, str]:
    """DuckDB form of ``lcc_project`` with the same constants."""
    from strata.functions.geo import (GRS80_A, LCC_FALSE_EASTING_M, LCC_FALSE_NORTHING_M, LCC_LON0,
                                      US_SURVEY_FOOT_PER_M, _lcc_constants)
    import math
    e, n, big_f, rho0 = _lcc_constants()
    phi = f"radians({lat})"
    es = f"({e!r} * sin({phi}))"
    t = f"(tan({math.pi / 4!r} - {phi} / 2) / pow((1.0 - {es}) / (1.0 + {es}), {e / 2!r}))"
    rho = f"({GRS80_A * big_f!r} * pow({t}, {n!r}))"
    theta = f"({n!r} * radians({lon} - ({LCC_LON0!r})))"
    x = f"(({LCC_FALSE_EASTING_M!r} + {rho} * sin({theta})) * {US_SURVEY_FOOT_PER_M!r})"
    y = f"(({LCC_FALSE_NORTHING_M + rho0!r} - {rho} * cos({theta})) * {US_SURVEY_FOOT_PER_M!r})"
    return x, y


_PX, _PY = _lcc_sql("plat", "plong")
_DX, _DY = _lcc_sql("dlat", "dlong")


@query("project_points", with_views(
    f"SELECT id, round({_PX}, 3) AS x_ft, round({_PY}, 3) AS y_ft FROM geo", "geo"))
def project_points(spark, d):
    """Pickup points WGS84 -> EPSG:6539 Long Island (US survey feet)."""
    g = views.geo(spark, d)
    x, y = lcc_project(F.col("plat"), F.col("plong"))
    return g.select("id", F.round(x, 3).alias("x_ft"), F.round(y, 3).alias("y_ft"))


@query("planar_distance", with_views(
    f"SELECT id, round(sqrt(({_DX} - {_PX}) * ({_DX} - {_PX}) + ({_DY} - {_PY}) * ({_DY} - {_PY})), 3)"
    " AS dist_ft FROM geo", "geo"))
def planar_distance_q(spark, d):
    """Planar distance between the projected pickup and dropoff points."""
    g = views.geo(spark, d)
    px, py = lcc_project(F.col("plat"), F.col("plong"))
    dx, dy = lcc_project(F.col("dlat"), F.col("dlong"))
    return g.select("id", F.round(planar_distance(px, py, dx, dy), 3).alias("dist_ft"))


_VERTICES_SQL = with_views("""
SELECT poly_id, ring, vertex, round(y1, 6) AS lat, round(x1, 6) AS long FROM area_edges
UNION ALL
SELECT poly_id, ring, vertex + 1, round(y2, 6), round(x2, 6) FROM area_edges WHERE last_edge""", "area_edges")


@query("polygon_vertices", _VERTICES_SQL)
def polygon_vertices(spark, d):
    """Every polygon vertex (closing vertex included) as (lat, long)."""
    return rounded(spatial.polygon_vertices(views.areas(spark, d)))


@query("polygon_bbox", with_views("""
SELECT poly_id, round(min(least(x1, x2)), 6) AS min_x, round(max(greatest(x1, x2)), 6) AS max_x,
       round(min(least(y1, y2)), 6) AS min_y, round(max(greatest(y1, y2)), 6) AS max_y
FROM area_edges GROUP BY poly_id""", "area_edges"))
def polygon_bbox(spark, d):
    t = spatial.polygon_table(views.areas(spark, d))
    return rounded(t.select("poly_id", "min_x", "max_x", "min_y", "max_y"))


def _hits(x: str = "x", y: str = "y", name: str = "hits", points: str = "points", edges: str = "area_edges") -> str:
    """DuckDB CTE: (id, poly_id, name) for points in or on an area polygon,
    by the even-odd crossing count over all ring edges plus an on-edge test."""
    return f"""{name} AS (
  SELECT id, poly_id, name FROM (
    SELECT p.id, e.poly_id, e.name,
      bool_or(((p.{x} - e.x1) * (e.y2 - e.y1) - (p.{y} - e.y1) * (e.x2 - e.x1)) = 0
              AND p.{x} >= least(e.x1, e.x2) AND p.{x} <= greatest(e.x1, e.x2)
              AND p.{y} >= least(e.y1, e.y2) AND p.{y} <= greatest(e.y1, e.y2)) AS on_edge,
      sum(CASE WHEN ((e.y1 > p.{y}) <> (e.y2 > p.{y}))
                AND ((p.{x} - e.x1) * (e.y2 - e.y1) - (e.x2 - e.x1) * (p.{y} - e.y1)) * sign(e.y2 - e.y1) < 0
               THEN 1 ELSE 0 END) AS crossings
    FROM {points} p, {edges} e GROUP BY p.id, e.poly_id, e.name)
  WHERE on_edge OR crossings % 2 = 1)"""


@query("spatial_join", with_views("SELECT id, poly_id, name FROM hits", "points", "area_edges",
                                  ctes=(_hits(),)))
def spatial_join(spark, d):
    """Pickup points joined to every area polygon holding them (boundary
    included; overlapping polygons give several rows)."""
    p = views.points(spark, d).select("id", "x", "y")
    return spatial.spatial_join(p, views.areas(spark, d)).select("id", "poly_id", "name")


_NAMES_SQL = with_views("""
SELECT p.id, CASE WHEN p.x IS NULL OR p.y IS NULL THEN NULL
                  ELSE coalesce(string_agg(h.name, ' | ' ORDER BY h.name), '') END AS names
FROM points p LEFT JOIN hits h ON p.id = h.id GROUP BY p.id, p.x, p.y""", "points", "area_edges",
                        ctes=(_hits(),))


@query("spatial_join_names", _NAMES_SQL)
def spatial_join_names(spark, d):
    """Per pickup point: names of the holding polygons, sorted, joined by
    ' | '; '' when none."""
    p = views.points(spark, d)
    return spatial.polygon_names(p, views.areas(spark, d), "id")


_PAIRS_SQL = with_views("""
SELECT pn.names AS pickup_area, dn.names AS dropoff_area, count(*) AS times
FROM pn JOIN dn ON pn.id = dn.id GROUP BY 1, 2""", "points", "area_edges", ctes=(
    _hits(), _hits("x2", "y2", "dhits"),
    """pn AS (SELECT p.id, coalesce(string_agg(h.name, ' | ' ORDER BY h.name), '') AS names
       FROM points p LEFT JOIN hits h ON p.id = h.id GROUP BY p.id)""",
    """dn AS (SELECT p.id, coalesce(string_agg(h.name, ' | ' ORDER BY h.name), '') AS names
       FROM points p LEFT JOIN dhits h ON p.id = h.id GROUP BY p.id)"""))


@query("pair_frequencies", _PAIRS_SQL)
def pair_frequencies(spark, d):
    """Frequencies of (pickup area, dropoff area) pairs, most frequent first."""
    from strata.operators.aggregates import frequencies
    return frequencies(views.area_names(spark, d), ["pickup_area", "dropoff_area"])


def _md5(key_sql: str, seed: int = 1) -> str:
    return f"md5(CAST({key_sql} AS VARCHAR) || ':{seed}')"


@query("nearest_centroid", with_views(f"""
SELECT id, CAST(cluster AS INTEGER) AS cluster FROM (
  SELECT g.id, c.cluster, row_number() OVER (PARTITION BY g.id ORDER BY
      (g.plat - c.clat) * (g.plat - c.clat) + (g.plong - c.clong) * (g.plong - c.clong), c.cluster) AS r
  FROM geo g, (SELECT row_number() OVER (ORDER BY {_md5('id')}, id) - 1 AS cluster, plat AS clat,
                      plong AS clong FROM geo ORDER BY {_md5('id')}, id LIMIT {K_CENTRES}) c)
WHERE r = 1""", "geo"))
def nearest_centroid(spark, d):
    """Nearest of 8 centres (a seeded sample of the points) for every point.
    The centres (8 rows, bounded by k) ride in the expression; no join."""
    g = views.geo(spark, d)
    centres = [(r["plat"], r["plong"]) for r in
               ordering.sample_n(g.select("id", "plat", "plong"), K_CENTRES, "id").collect()]
    return spatial.nearest_centre(g.select("id", "plat", "plong"), centres, ["plat", "plong"]) \
        .select("id", F.col("cluster").cast("int").alias("cluster"))


# the areas as parts of a map near New York, in degrees; edges are cut for the projection at this length
MAP_X, MAP_Y, MAP_SCALE, BEND_STEP = -74.3, 40.2, 0.5, 0.02


def _feet_sql() -> str:
    def at(j):
        return tuple(f"CASE WHEN {j} = n THEN {c}2 ELSE {c}1 + ({c}2 - {c}1) * {j} / n END" for c in ("x", "y"))
    (ax, ay), (bx, by) = at("j"), at("(j + 1)")
    x1, y1 = _lcc_sql(f"({ay})", f"({ax})")
    x2, y2 = _lcc_sql(f"({by})", f"({bx})")
    return with_views("SELECT id, poly_id, name FROM hits", "geo", "area_edges", ctes=(
        f"""degrees AS (SELECT poly_id, name, {MAP_X} + {MAP_SCALE} * x1 AS x1, {MAP_Y} + {MAP_SCALE} * y1 AS y1,
              {MAP_X} + {MAP_SCALE} * x2 AS x2, {MAP_Y} + {MAP_SCALE} * y2 AS y2 FROM area_edges)""",
        f"""pieces AS (SELECT *, unnest(range(0, n)) AS j FROM (
              SELECT *, greatest(1, CAST(ceil(greatest(abs(x2 - x1), abs(y2 - y1)) / {BEND_STEP}) AS BIGINT)) AS n FROM degrees))""",
        f"feet AS (SELECT poly_id, name, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM pieces)",
        f"places AS (SELECT id, {_PX} AS x, {_PY} AS y FROM geo)",
        _hits(points="places", edges="feet")))


@query("join_in_feet", _feet_sql())
def join_in_feet(spark, d):
    """Pickup points and polygons given in degrees, both projected to feet,
    the polygons with vertices added where a straight edge bends; then the
    points in or on each polygon."""
    def to_degrees(ring):
        return F.transform(ring, lambda p: F.struct((F.lit(MAP_X) + F.lit(MAP_SCALE) * p["x"]).alias("x"),
                                                    (F.lit(MAP_Y) + F.lit(MAP_SCALE) * p["y"]).alias("y")))
    # the projection is the work here, and a small table arrives in one task
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    polys = views.areas(spark, d).repartition(parts, "poly_id").withColumn("rings", F.transform("rings", to_degrees))
    polys = polys.withColumn("rings", project_rings("rings", BEND_STEP))
    x, y = lcc_project(F.col("plat"), F.col("plong"))
    places = views.geo(spark, d).select("id", x.alias("x"), y.alias("y"))
    return spatial.spatial_join(places, polys).select("id", "poly_id", "name")
