"""Geometry as native Column expressions (metres, degrees, radius 6,371,000 m)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: Metres in one degree of latitude on that sphere.
DEGREE_M = 111_194.92664455873


def _c(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def haversine(lng1, lat1, lng2, lat2) -> Column:
    """Great-circle distance in metres; null if any coordinate is null."""
    a, b, c, d = map(_c, (lng1, lat1, lng2, lat2))
    dlat, dlng = F.radians(d - b), F.radians(c - a)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(b)) * F.cos(F.radians(d)) * F.pow(F.sin(dlng / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(h), F.sqrt(F.greatest(1 - h, F.lit(0.0))))


def bearing(lng1, lat1, lng2, lat2) -> Column:
    """Initial great-circle bearing, 0 to 360 degrees clockwise from north."""
    a, b, c, d = map(_c, (lng1, lat1, lng2, lat2))
    dl, p, q = F.radians(c - a), F.radians(b), F.radians(d)
    y = F.sin(dl) * F.cos(q)
    x = F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def planar_bearing(lng1, lat1, lng2, lat2) -> Column:
    """Direction in the plane of degrees, -180 to 180; no cosine correction, so not :func:`bearing`."""
    a, b, c, d = map(_c, (lng1, lat1, lng2, lat2))
    return F.degrees(F.atan2(c - a, d - b))


def angle_between(a, b) -> Column:
    """Smallest difference of two directions in degrees, 0 to 180."""
    d = F.pmod(F.abs(_c(a) - _c(b)), F.lit(360.0))
    return F.least(d, 360.0 - d)


#: The eight compass labels from north clockwise.
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def compass(deg) -> Column:
    """Label of the nearest eighth of the compass."""
    k = F.pmod(F.floor(_c(deg) / 45.0 + 0.5).cast("int"), F.lit(8))
    return F.element_at(F.array(*map(F.lit, COMPASS)), k + 1)


def cell(x, res: float) -> Column:
    """Index of the grid cell of one coordinate: floor, never truncation."""
    return F.floor(_c(x).cast("double") / F.lit(float(res))).cast("long")


def half_up(x, digits: int = 0) -> Column:
    """Rounding with halves towards plus infinity."""
    k = 10.0**digits
    return F.floor(_c(x) * k + 0.5) / k


def on_earth(lng, lat) -> Column:
    """True for coordinates that are present and within range; never null."""
    ok = _c(lat).between(-90.0, 90.0) & _c(lng).between(-180.0, 180.0)
    return F.coalesce(ok, F.lit(False))


def line_length(points: Column, x: str = "lng", y: str = "lat") -> Column:
    """Metres along an array of structs; 0 for fewer than two points."""
    n = F.size(points)
    legs = F.zip_with(
        F.slice(points, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(points, 2, F.greatest(n - 1, F.lit(0))),
        lambda p, q: haversine(p[x], p[y], q[x], q[y]),
    )
    return F.when(n < 2, F.lit(0.0)).otherwise(
        F.aggregate(legs, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    )


def sampled(points: Column, n: int = 5) -> Column:
    """All of up to n points, else every k-th from the first, k being the n-th part of their number."""
    step = F.greatest(F.floor(F.size(points) / n), F.lit(1))
    return F.when(F.size(points) <= n, points).otherwise(F.filter(points, lambda _, i: i % step == 0))


def centroid(points: Column, x: str = "lng", y: str = "lat") -> Column:
    """Mean of the vertices as struct<lng,lat>; null for an empty array."""
    n = F.size(points)
    mean = lambda k: F.aggregate(points, F.lit(0.0), lambda s, p: s + p[k]) / n
    return F.when(n > 0, F.struct(mean(x).alias("lng"), mean(y).alias("lat")))


def endpoints(points: Column) -> tuple[Column, Column]:
    """First and last point; null for an empty array."""
    return F.try_element_at(points, F.lit(1)), F.try_element_at(points, F.lit(-1))


def destination(lng, lat, bearing_deg, metres) -> tuple[Column, Column]:
    """(lng, lat) reached from a point along a bearing."""
    a, p, t, d = _c(lng), F.radians(_c(lat)), F.radians(_c(bearing_deg)), _c(metres) / EARTH_M
    q = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(t))
    l2 = F.radians(a) + F.atan2(F.sin(t) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(q))
    return F.degrees(l2), F.degrees(q)


def in_ring(lng, lat, ring: Column, x: str = "lng", y: str = "lat") -> Column:
    """Even-odd test of a point against one closed or open ring (array of structs)."""
    px, py, n = _c(lng), _c(lat), F.size(ring)
    nxt = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, F.least(n, F.lit(1))))
    hits = F.zip_with(
        ring,
        nxt,
        lambda a, b: F.when(
            ((a[y] > py) != (b[y] > py)) & (px < (b[x] - a[x]) * (py - a[y]) / (b[y] - a[y]) + a[x]), F.lit(1)
        ).otherwise(F.lit(0)),
    )
    return F.when(n < 3, F.lit(False)).otherwise(F.aggregate(hits, F.lit(0), lambda s, v: s + v) % 2 == 1)
