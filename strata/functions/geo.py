"""Geometry as plain columns: points are (x, y) doubles, polygons are
``array<array<struct<x,y>>>`` rings (outer ring first, then holes), and
the exact point-in-polygon test runs as higher-order array functions
inside the JVM, so no Python touches a row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius used by great-circle distance.
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_MI = 3958.756


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance between two (lat, lon) points in degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s1, s2 = F.sin(dlat / 2), F.sin(dlon / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * (s2 * s2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(a))


def planar_distance(x1, y1, x2, y2) -> Column:
    """Euclidean distance in the plane (projected coordinates)."""
    dx = _c(x2) - _c(x1)
    dy = _c(y2) - _c(y1)
    return F.sqrt(dx * dx + dy * dy)


# EPSG:6539, NAD83(2011) / New York Long Island (ftUS),
# Lambert conformal conic with two standard parallels on GRS80.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
LCC_LAT1 = 41.0 + 2.0 / 60.0
LCC_LAT2 = 40.0 + 40.0 / 60.0
LCC_LAT0 = 40.0 + 10.0 / 60.0
LCC_LON0 = -74.0
LCC_FALSE_EASTING_M = 300000.0
LCC_FALSE_NORTHING_M = 0.0
US_SURVEY_FOOT_PER_M = 3937.0 / 1200.0


def _lcc_constants():
    f = 1.0 / GRS80_INV_F
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        es = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (LCC_LAT1, LCC_LAT2, LCC_LAT0))
    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


def lcc_project(lat, lon) -> tuple[Column, Column]:
    """WGS84 degrees -> EPSG:6539 (x, y) in US survey feet.

    Closed-form Lambert conformal conic; the datum shift between WGS84 and
    NAD83(2011) is below a metre and ignored, as a plain 4326->6539
    transform does.
    """
    e, n, big_f, rho0 = _lcc_constants()
    phi = F.radians(_c(lat))
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    rho = F.lit(GRS80_A * big_f) * F.pow(t, F.lit(n))
    theta = F.lit(n) * F.radians(_c(lon) - F.lit(LCC_LON0))
    x = (F.lit(LCC_FALSE_EASTING_M) + rho * F.sin(theta)) * F.lit(US_SURVEY_FOOT_PER_M)
    y = (F.lit(LCC_FALSE_NORTHING_M + rho0) - rho * F.cos(theta)) * F.lit(US_SURVEY_FOOT_PER_M)
    return x, y


def project_rings(rings, step: float) -> Column:
    """Rings of (x = longitude, y = latitude) in EPSG:6539 feet.  A straight
    edge in degrees bends in the projection, so an edge of more than
    ``step`` degrees gets vertices added at equal distances of at most that.
    """
    def point(x, y):
        px, py = lcc_project(y, x)
        return F.struct(px.alias("x"), py.alias("y"))

    def along(ring, i):
        a, b = ring[i], ring[i + 1]
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / F.lit(float(step))).cast("int"))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda j: point(a["x"] + dx * j / n, a["y"] + dy * j / n))

    def whole(ring):
        last = F.element_at(ring, -1)
        inner = F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: along(ring, i)))
        return F.when(F.size(ring) > 1, F.concat(inner, F.array(point(last["x"], last["y"])))).otherwise(
            F.transform(ring, lambda p: point(p["x"], p["y"])))
    return F.transform(_c(rings), whole)


def ring_edges(rings) -> Column:
    """Flatten polygon rings into one edge array of struct(x1, y1, x2, y2).

    Each ring is closed (first vertex repeated last, as GeoJSON requires).
    """
    def edges_of(ring):
        idx = F.slice(F.sequence(F.lit(0), F.greatest(F.size(ring) - 1, F.lit(0))), F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
        return F.transform(idx, lambda i: F.struct(
            ring[i]["x"].alias("x1"), ring[i]["y"].alias("y1"),
            ring[i + 1]["x"].alias("x2"), ring[i + 1]["y"].alias("y2")))
    return F.flatten(F.transform(_c(rings), edges_of))


def finite_edges(edges) -> Column:
    """The edges whose ends both have finite coordinates."""
    return F.filter(_c(edges), lambda e: (F.abs(e["x1"]) < math.inf) & (F.abs(e["y1"]) < math.inf)
                    & (F.abs(e["x2"]) < math.inf) & (F.abs(e["y2"]) < math.inf))


def point_on_edges(px, py, edges) -> Column:
    """True when the point lies on any edge (collinear and within its box)."""
    px, py = _c(px), _c(py)

    def on(e):
        cross = (px - e["x1"]) * (e["y2"] - e["y1"]) - (py - e["y1"]) * (e["x2"] - e["x1"])
        return ((cross == 0)
                & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
                & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))
    return F.exists(_c(edges), on)


def point_crosses_odd(px, py, edges) -> Column:
    """Even-odd rule: an odd number of edges cross the ray to +x.

    The crossing test is written without division (sign-aware cross
    product), so horizontal edges never divide by zero.
    """
    px, py = _c(px), _c(py)

    def crosses(e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        side = ((px - e["x1"]) * (e["y2"] - e["y1"]) - (e["x2"] - e["x1"]) * (py - e["y1"])) \
            * F.signum(e["y2"] - e["y1"])
        return straddles & (side < 0)
    n = F.size(F.filter(_c(edges), crosses))
    return (n % 2) == 1


def point_in_polygon(px, py, edges) -> Column:
    """Closed-set containment (interior or boundary), like ``intersects``."""
    return point_on_edges(px, py, edges) | point_crosses_odd(px, py, edges)


def _side(qx, qy, e) -> Column:
    """Sign of the side of an edge on which a grid corner lies; the corner
    is taken a hair above, and less of a hair to the right, of (qx, qy), so
    that it is on no edge."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    s = (qx - e["x1"]) * dy - (qy - e["y1"]) * dx
    return F.when(s != 0, F.signum(s)).when(dy != 0, F.signum(dy)).otherwise(-F.signum(dx))


def _right_of(qx, qy, e) -> Column:
    """Does an edge that straddles the corner's height cross it to the right?"""
    return (F.when(qx >= F.greatest(e["x1"], e["x2"]), False).when(qx < F.least(e["x1"], e["x2"]), True)
            .otherwise(_side(qx, qy, e) * F.signum(e["y2"] - e["y1"]) < 0))


def _above(qx, qy, e) -> Column:
    """Does an edge that straddles the corner's x cross it above?"""
    return (F.when(qy >= F.greatest(e["y1"], e["y2"]), False).when(qy < F.least(e["y1"], e["y2"]), True)
            .otherwise(_side(qx, qy, e) * F.signum(e["x2"] - e["x1"]) > 0))


def _odd(edges, crossed) -> Column:
    return F.size(F.filter(edges, crossed)) % 2 == 1


def corner_inside(qx, qy, edges, x0=None, y0=None) -> Column:
    """Even-odd rule for a grid corner.  With ``x0`` and ``y0``, whether the
    corner is on the other side than the corner (x0, y0): the edges crossed
    on the way up from there and then to the right, which need only be those
    of the cell that holds the way."""
    if x0 is None:
        return _odd(edges, lambda e: ((e["y1"] > qy) != (e["y2"] > qy)) & _right_of(qx, qy, e))
    return _odd(edges, lambda e: _up(x0, y0, qy, e) != (
        ((e["y1"] > qy) != (e["y2"] > qy)) & (_right_of(x0, qy, e) != _right_of(qx, qy, e))))


def _up(x0, y0, y1, e) -> Column:
    """Is an edge crossed on the way from the corner (x0, y0) up to (x0, y1)?"""
    return ((e["x1"] > x0) != (e["x2"] > x0)) & (_above(x0, y0, e) != _above(x0, y1, e))


def point_in_cell(px, py, x0, y0, edges, inside) -> Column:
    """Closed-set containment of a point in the cell with the lower left
    corner (x0, y0), from the cell's edges and whether that corner is
    inside.  The way from the corner goes up to the point's height and then
    to the right; where it turns, both legs judge an edge by one and the
    same sign, so rounding cannot make them disagree."""
    def crossed(e):
        right = ((px - e["x1"]) * (e["y2"] - e["y1"]) - (e["x2"] - e["x1"]) * (py - e["y1"])) * F.signum(e["y2"] - e["y1"]) < 0
        return _up(x0, y0, py, e) != (((e["y1"] > py) != (e["y2"] > py)) & (_right_of(x0, py, e) != right))
    return point_on_edges(px, py, edges) | (inside != _odd(edges, crossed))
