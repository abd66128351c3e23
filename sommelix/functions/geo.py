"""Geometry as Column expressions: rings are arrays of struct<x double, y double>, closed (first point repeated)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0

# The Lambert conic conformal projection of metropolitan France on the GRS80 ellipsoid.
_A, _F = 6378137.0, 1 / 298.257222101
_E = math.sqrt(2 * _F - _F * _F)
_PHI0, _PHI1, _PHI2, _LAMBDA0 = (math.radians(d) for d in (46.5, 44.0, 49.0, 3.0))
_FALSE_EAST, _FALSE_NORTH = 700000.0, 6600000.0


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (_E * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    s = _E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


CONE = (math.log(_m(_PHI1)) - math.log(_m(_PHI2))) / (math.log(_t(_PHI1)) - math.log(_t(_PHI2)))
SCALE = _A * _m(_PHI1) / (CONE * _t(_PHI1) ** CONE)
RADIUS0 = SCALE * _t(_PHI0) ** CONE


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    v = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(v), F.sqrt(1 - v))


def lambert93(lon: Column, lat: Column) -> Column:
    """Degrees to metres, as struct x, y."""
    phi = F.radians(lat)
    s = _E * F.sin(phi)
    r = SCALE * F.pow(F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2)), F.lit(CONE))
    angle = CONE * (F.radians(lon) - _LAMBDA0)
    return F.struct((_FALSE_EAST + r * F.sin(angle)).alias("x"), (_FALSE_NORTH + RADIUS0 - r * F.cos(angle)).alias("y"))


def from_lambert93(x: Column, y: Column, rounds: int = 6) -> Column:
    """Metres to degrees, as struct lon, lat; latitude by fixed-point rounds."""
    dx, dy = x - _FALSE_EAST, RADIUS0 - (y - _FALSE_NORTH)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / SCALE, F.lit(1 / CONE))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = _E * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(_E / 2)))
    return F.struct(F.degrees(_LAMBDA0 + F.atan2(dx, dy) / CONE).alias("lon"), F.degrees(phi).alias("lat"))


def _edges(ring: str) -> str:
    return f"transform(sequence(0, size({ring}) - 2), i -> struct({ring}[i] AS a, {ring}[i + 1] AS b))"


def _area_edges(rings: str) -> str:
    return f"flatten(transform({rings}, r -> {_edges('r')}))"


def ring_area(ring: str) -> Column:
    """Shoelace area of the named ring column, never negative."""
    return F.expr(f"abs(aggregate({_edges(ring)}, 0D, (s, e) -> s + (e.a.x * e.b.y - e.b.x * e.a.y))) / 2")


def _on_edge(edges: str, x: str, y: str) -> Column:
    return F.expr(
        f"exists({edges}, e -> (e.b.x - e.a.x) * ({y} - e.a.y) = (e.b.y - e.a.y) * ({x} - e.a.x)"
        f" AND {x} BETWEEN least(e.a.x, e.b.x) AND greatest(e.a.x, e.b.x)"
        f" AND {y} BETWEEN least(e.a.y, e.b.y) AND greatest(e.a.y, e.b.y))"
    )


def _inside(edges: str, x: str, y: str) -> Column:
    crossed = F.expr(
        f"size(filter({edges}, e -> ((e.a.y > {y}) <> (e.b.y > {y}))"
        f" AND {x} < (e.b.x - e.a.x) * ({y} - e.a.y) / nullif(e.b.y - e.a.y, 0) + e.a.x)) % 2 = 1"
    )
    return crossed & ~_on_edge(edges, x, y)


def _distance(edges: str, x: str, y: str) -> Column:
    nearest = F.expr(
        f"array_min(transform({edges}, e -> transform(array(struct(e.b.x - e.a.x AS dx, e.b.y - e.a.y AS dy)), d ->"
        f" transform(array(greatest(0D, least(1D, coalesce((({x} - e.a.x) * d.dx + ({y} - e.a.y) * d.dy)"
        f" / nullif(d.dx * d.dx + d.dy * d.dy, 0), 0D)))), t ->"
        f" sqrt(pow({x} - e.a.x - t * d.dx, 2) + pow({y} - e.a.y - t * d.dy, 2)))[0])[0]))"
    )
    return F.when(_inside(edges, x, y) | _on_edge(edges, x, y), 0.0).otherwise(nearest)


def on_boundary(ring: str, x: str, y: str) -> Column:
    return _on_edge(_edges(ring), x, y)


def within(ring: str, x: str, y: str) -> Column:
    """Point strictly inside: an odd number of edges to its right, and not on the boundary."""
    return _inside(_edges(ring), x, y)


def distance_to_ring(ring: str, x: str, y: str) -> Column:
    """Distance to the ring's area: 0 inside, else to the nearest edge."""
    return _distance(_edges(ring), x, y)


def within_area(rings: str, x: str, y: str) -> Column:
    """Point strictly inside an area of disjoint parts with holes, given as an array of all its rings."""
    return _inside(_area_edges(rings), x, y)


def distance_to_area(rings: str, x: str, y: str) -> Column:
    """Distance to such an area: 0 inside and on any ring, else to the nearest edge, of a hole as well."""
    return _distance(_area_edges(rings), x, y)


def envelope(ring: str) -> Column:
    return F.expr(
        f"struct(array_min({ring}.x) AS min_x, array_min({ring}.y) AS min_y, array_max({ring}.x) AS max_x, array_max({ring}.y) AS max_y)"
    )
