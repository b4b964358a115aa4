"""Point-in-polygon join, nearest-centre assignment and polygon helpers.

Polygons are rows ``(poly_id, name, rings)`` where ``rings`` is
``array<array<struct<x: double, y: double>>>`` (outer ring, then holes).
The join never compares every point with every polygon, nor a point with a
whole polygon: polygons are cut into grid cells that hold only the edges
that cross them and whether their corner lies inside, and a point is tested
against the cell that it falls into, all as JVM expressions.  An edge whose
end has no finite coordinates (a vertex outside of a projection) is touched
and crossed by no point; the polygons left open by it go through a join of
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.geo import corner_inside, finite_edges, point_in_cell, point_in_polygon, ring_edges
from strata.session import reliable


def polygon_table(polys: DataFrame, rings_col: str = "rings") -> DataFrame:
    """Add edges and the bounding box of every polygon."""
    pts = F.flatten(F.col(rings_col))
    return polys.withColumns({
        "edges": ring_edges(F.col(rings_col)),
        "min_x": F.array_min(F.transform(pts, lambda p: p["x"])),
        "max_x": F.array_max(F.transform(pts, lambda p: p["x"])),
        "min_y": F.array_min(F.transform(pts, lambda p: p["y"])),
        "max_y": F.array_max(F.transform(pts, lambda p: p["y"])),
    })


def polygon_vertices(polys: DataFrame, rings_col: str = "rings") -> DataFrame:
    """One row per vertex: (poly_id, ring, vertex, lat, long) (lat = y, long = x)."""
    r = polys.select("poly_id", F.posexplode(F.col(rings_col)).alias("ring", "_pts"))
    v = r.select("poly_id", "ring", F.posexplode("_pts").alias("vertex", "_p"))
    return v.select("poly_id", "ring", "vertex", F.col("_p.y").alias("lat"), F.col("_p.x").alias("long"))


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level)).cast("long")


EDGES = 16               # edges of a cell that is not cut further, if it can be
_DIGITS = 50             # a cell number keeps this many bits, so cell borders are exact doubles
_STEP = 2                # a cell is cut into 2^_STEP x 2^_STEP
_LEVELS = 24             # levels below a polygon's own, at most


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _crossing(edges: Column, cx: Column, cy: Column, level: Column) -> Column:
    """The edges that may touch the closed cell; a few near it as well."""
    half = _size(level) / 2
    mx, my = (cx * 2 + 1) * half, (cy * 2 + 1) * half

    def touches(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        a, b = (mx - e["x1"]) * dy, (my - e["y1"]) * dx
        reach = half * (F.abs(dx) + F.abs(dy)) * (1 + 1e-9) + (F.abs(a) + F.abs(b)) * 1e-12
        return ((F.least(e["x1"], e["x2"]) <= mx + half) & (F.greatest(e["x1"], e["x2"]) >= mx - half)
                & (F.least(e["y1"], e["y2"]) <= my + half) & (F.greatest(e["y1"], e["y2"]) >= my - half)
                & (F.abs(a - b) <= reach))
    return F.filter(edges, touches)


def _edge_table(polys: DataFrame) -> DataFrame:
    """(poly_id, name, edges, min_x, max_x, min_y, max_y, open): the edges
    with finite ends, their extent, and whether others were left out."""
    every = polys.select("poly_id", "name", ring_edges("rings").alias("_every"))
    sound = every.select("poly_id", "name", F.size("_every").alias("_n"), finite_edges("_every").alias("edges"))

    def over(reduce, pick, c):
        return reduce(F.transform("edges", lambda e: pick(e[f"{c}1"], e[f"{c}2"])))
    return sound.select("poly_id", "name", "edges", (F.size("edges") < F.col("_n")).alias("open"),
                        *[over(reduce, pick, c).alias(f"{end}_{c}") for c in ("x", "y")
                          for end, reduce, pick in (("min", F.array_min, F.least), ("max", F.array_max, F.greatest))])


def cell_index(polys: DataFrame, most: int = EDGES) -> DataFrame:
    """(poly_id, name, _level, _cx, _cy, _inside, _edges): each polygon as
    disjoint cells of 2^_level units.  ``_edges`` are the edges that cross
    the cell and ``_inside`` tells whether its lower left corner (a hair
    above and to the right of it) lies inside; cells without either are left
    out.  Polygons left open by edges without finite ends are not in it.

    A polygon begins as the at most four cells of the power of two above
    its extent, whatever the units of its coordinates.  A cell with more
    than ``most`` edges is cut into 16, each with the edges that cross it and
    the corner found from the parent's, until it has fewer or is a 2^24-th
    of the polygon (many edges in one vertex) or nears the resolution of the
    coordinates.  So a cell's edges, and the work for a point, do not grow
    with the polygon.
    """
    pt = _edge_table(polys).where(~F.col("open"))
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    largest = F.greatest(F.abs(F.col("min_x")), F.abs(F.col("max_x")), F.abs(F.col("min_y")), F.abs(F.col("max_y")))
    finest = F.when(largest > 0, F.ceil(F.log2(largest))).otherwise(F.lit(0)) - _DIGITS
    level = F.greatest(F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(finest), finest).cast("int")
    lv, cx, cy, edges = F.col("_level"), F.col("_cx"), F.col("_cy"), F.col("_edges")
    cells = pt.withColumns({"_level": level, "_finest": F.greatest(finest.cast("int") + _STEP, level - _LEVELS),
                            "_all": F.col("edges")}).select(
        "poly_id", "name", "_level", "_finest", "_all", "min_y", "max_y", F.explode(
            F.sequence(_cell(F.col("min_x"), lv), _cell(F.col("max_x"), lv))).alias("_cx")).withColumn(
        "_cy", F.explode(F.sequence(_cell(F.col("min_y"), lv), _cell(F.col("max_y"), lv))))
    cells = cells.select(
        "poly_id", "name", "_level", "_cx", "_cy", "_finest", _crossing(F.col("_all"), cx, cy, lv).alias("_edges"),
        corner_inside(cx * _size(lv), cy * _size(lv), F.col("_all")).alias("_inside"))
    out = None
    while True:
        cells = cells.where((F.size("_edges") > 0) | F.col("_inside"))
        large = (F.size("_edges") > most) & (F.col("_level") >= F.col("_finest"))
        if out is None and pt.where(F.size("edges") > most).isEmpty():
            return cells.drop("_finest")
        cells = reliable(cells)
        done = cells.where(~large)
        out = done if out is None else out.unionByName(done)
        if cells.where(large).isEmpty():
            return out.drop("_finest")
        # the parent's edges tell whether a child's corner is on the same side as the parent's
        side, least = 1 << _STEP, lv - _STEP
        child = cells.where(large).repartition("poly_id", "_cx", "_cy").select("*", F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(side) for j in range(side)])).alias("_q"))
        kx, ky, h = cx * side + F.col("_q.i"), cy * side + F.col("_q.j"), _size(least)
        # new names first: a column must not be read under the name of another one
        cells = child.select("poly_id", "name", "_finest", least.alias("_l"), kx.alias("_x"), ky.alias("_y"),
                             _crossing(edges, kx, ky, least).alias("_e"),
                             (F.col("_inside") != corner_inside(kx * h, ky * h, edges, cx * _size(lv), cy * _size(lv)))
                             .alias("_i")).select("poly_id", "name", F.col("_l").alias("_level"), F.col("_x").alias("_cx"),
                                                  F.col("_y").alias("_cy"), "_finest", F.col("_e").alias("_edges"),
                                                  F.col("_i").alias("_inside"))


def spatial_join(points: DataFrame, polys: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs (point row, poly_id, name) with the point in or on the polygon.

    A point may hit several (overlapping) polygons; a point without
    coordinates hits none.  A point probes its one cell on each level of the
    polygons' ``cell_index`` (a scalar subquery; levels are binary
    exponents, so few) and is tested there with the cell's edges alone; AQE
    splits a hot cell.  The polygons, which several jobs read, are computed
    once, into the checkpoint folder.
    """
    polys = reliable(polys.select("poly_id", "name", "rings"))
    cells = cell_index(polys)
    levels = cells.agg(F.collect_set("_level")).scalar()
    lv = F.col("_level")
    placed = points.where(~F.isnan(x) & ~F.isnan(y))
    probe = placed.withColumn("_level", F.explode(levels)).withColumns({
        "_cx": _cell(F.col(x), lv), "_cy": _cell(F.col(y), lv)})
    hits = (probe.join(cells, ["_level", "_cx", "_cy"])
            .where(point_in_cell(F.col(x), F.col(y), F.col("_cx") * _size(lv), F.col("_cy") * _size(lv),
                                 F.col("_edges"), F.col("_inside")))
            .select(*points.columns, "poly_id", "name"))
    unclosed = _edge_table(polys).where(F.col("open") & (F.size("edges") > 0))
    return hits if unclosed.isEmpty() else hits.unionByName(_open_join(placed, unclosed, x, y))


def _open_join(points: DataFrame, pt: DataFrame, x: str, y: str) -> DataFrame:
    """``spatial_join`` with polygons left open.  What counts as inside may
    reach without end to the left of the edges, but not above, below or to
    the right of them: a polygon is cut into the at most two bands of the
    power of two above its height, each with the edges that reach into it."""
    height, largest = F.col("max_y") - F.col("min_y"), F.greatest(F.abs(F.col("min_y")), F.abs(F.col("max_y")))
    finest = F.when(largest > 0, F.ceil(F.log2(largest))).otherwise(F.lit(0)) - _DIGITS
    level = F.greatest(F.when(height > 0, F.ceil(F.log2(height))).otherwise(finest), finest).cast("int")
    lv, cy = F.col("_level"), F.col("_cy")
    bands = pt.withColumn("_level", level).withColumn(
        "_cy", F.explode(F.sequence(_cell(F.col("min_y"), lv), _cell(F.col("max_y"), lv)))).withColumn(
        "_edges", F.filter("edges", lambda e: (F.least(e["y1"], e["y2"]) <= (cy + 1) * _size(lv))
                           & (F.greatest(e["y1"], e["y2"]) >= cy * _size(lv)))).select(
        "poly_id", "name", "_level", "_cy", "_edges", "min_y", "max_y", "max_x")
    levels = bands.agg(F.collect_set("_level")).scalar()
    probe = points.withColumn("_level", F.explode(levels)).withColumn("_cy", _cell(F.col(y), lv))
    near = F.col(y).between(F.col("min_y"), F.col("max_y")) & (F.col(x) <= F.col("max_x"))
    return probe.join(bands, ["_level", "_cy"]).where(near & point_in_polygon(x, y, F.col("_edges"))).select(
        *points.columns, "poly_id", "name")


def polygon_names(points: DataFrame, polys: DataFrame, id_col: str, ends: list[tuple] | None = None,
                  sep: str = " | ") -> DataFrame:
    """Per point row: for each (x, y, out) of ``ends`` a column ``out`` with
    the names of all polygons holding that end, sorted and joined by
    ``sep``; ``""`` when none, NULL when a coordinate is NULL.  All ends go
    through one spatial join; ``id_col`` names a row."""
    ends = ends or [("x", "y", "names")]
    sides = points.select(F.col(id_col).alias("_id"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("_end"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        for i, (x, y, _) in enumerate(ends)])).alias("_s")).select("_id", "_s.*").where("_x is not null and _y is not null")
    hits = spatial_join(sides, polys, x="_x", y="_y").groupBy("_id").agg(*[
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("_end") == i, F.col("name")))), sep).alias(f"_names{i}")
        for i in range(len(ends))])
    out = points.join(hits, F.col(id_col) == F.col("_id"), "left")
    return out.select(id_col, *[
        F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.coalesce(f"_names{i}", F.lit(""))).alias(name)
        for i, (x, y, name) in enumerate(ends)])


def nearest_centre(points: DataFrame, centres: list[tuple], cols: list[str],
                   out_col: str = "cluster", dist_col: str | None = None) -> DataFrame:
    """Index of the nearest centre (squared Euclidean; ties -> lower index),
    and in ``dist_col`` its squared distance.

    ``centres`` is a short driver-side list (k fitted or sampled centres,
    bounded by k); it travels inside the expression as an array literal,
    so the points are neither shuffled nor joined.
    """
    arr = F.array(*[
        F.struct(F.lit(i).alias("id"), F.array(*[F.lit(float(v)) for v in c]).alias("c"))
        for i, c in enumerate(centres)])
    pvec = F.array(*[F.col(c).cast("double") for c in cols])

    def dist(cen):
        d = F.zip_with(pvec, cen["c"], lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(d, F.lit(0.0), lambda acc, v: acc + v).alias("d"),
                        cen["id"].alias("id"))
    best = F.array_min(F.transform(arr, dist))
    if dist_col is None:
        return points.withColumn(out_col, best["id"])
    return points.withColumn("_best", best).withColumns({out_col: F.col("_best.id"), dist_col: F.col("_best.d")}).drop("_best")


def lloyd_kmeans(points: DataFrame, cols: list[str], init: list[tuple], iterations: int) -> list[list[float]]:
    """Lloyd's k-means from given starting centres: each round assigns every
    point to its nearest centre (no shuffle, centres in the expression) and
    moves each centre to the mean of its points (one partial aggregate);
    only the k centres travel to the driver.  A centre that loses all its
    points stays where it was."""
    centres = [list(map(float, c)) for c in init]
    for _ in range(iterations):
        assigned = nearest_centre(points, centres, cols, out_col="_c")
        means = assigned.groupBy("_c").agg(*[F.avg(c).alias(c) for c in cols]).collect()
        for r in means:
            centres[r["_c"]] = [float(r[c]) for c in cols]
    return centres
