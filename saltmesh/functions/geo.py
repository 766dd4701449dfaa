"""Distances, longitudes, grid ids and text forms of shapes, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean Earth radius in km; WGS84 axis in m and flattening.
RADIUS_KM, AXIS, FLATTENING = 6371.0, 6378137.0, 1 / 298.257223563
#: Cells of the lookup grid per degree.
PER_DEGREE = 100


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    h = a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def ellipsoid_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance over the ellipsoid by the curvature at the middle latitude: right to 1e-4 for some tens of km."""
    e2 = FLATTENING * (2 - FLATTENING)
    mid = F.radians((lat1 + lat2) / 2)
    w = 1 - e2 * F.sin(mid) * F.sin(mid)
    north = F.radians(lat2 - lat1) * AXIS * (1 - e2) / (w * F.sqrt(w))
    east = F.radians(wrapped(lon2 - lon1)) * AXIS * F.cos(mid) / F.sqrt(w)
    return F.sqrt(north * north + east * east)


def wrapped(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def westward(lon: Column) -> Column:
    return F.when(lon > 0, lon - 360).otherwise(lon)


def near_dateline(lons: Column) -> Column:
    """An array of longitudes moved to the side of their mean where it spans over 180 degrees."""
    mean = F.aggregate(lons, F.lit(0.0), lambda s, x: s + x) / F.size(lons)
    span = F.array_max(lons) - F.array_min(lons)
    moved = F.transform(lons, lambda x: F.when(mean >= 0, F.when(x < 0, x + 360).otherwise(x)).otherwise(F.when(x > 0, x - 360).otherwise(x)))
    return F.when(span > 180, moved).otherwise(lons)


def crosses_dateline(lons: list[Column]) -> Column:
    """Whether any two corners are over 180 degrees apart."""
    pairs = [F.abs(a - b) for k, a in enumerate(lons) for b in lons[k + 1 :]]
    return F.greatest(*pairs) > 180


def utm_zone(lon: Column, lat: Column) -> Column:
    """UTM zone, with the wide zones of south-west Norway and of Svalbard."""
    plain = (F.floor((lon + 180) / 6) % 60 + 1).cast("int")
    svalbard = F.when(lon.between(0, 9) & (lon < 9), 31).when((lon >= 9) & (lon < 21), 33).when((lon >= 21) & (lon < 33), 35).when((lon >= 33) & (lon < 42), 37)
    return F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32).when((lat >= 72) & (lat < 84), F.coalesce(svalbard, plain)).otherwise(plain)


def utm_epsg(zone: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600 + zone).otherwise(32700 + zone)


def utm_to_lonlat(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude of northern UTM coordinates, by Krueger's series to the third order."""
    n = FLATTENING / (2 - FLATTENING)
    a = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    xi, eta = y / (0.9996 * a), (x - 500000.0) / (0.9996 * a)
    xi1, eta1 = xi, eta
    for k, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        eta1 = eta1 - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi
    for k, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * k * chi)
    lon = F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + (zone * 6 - 183)
    return lon, F.degrees(phi)


def destination(lat: Column, lon: Column, bearing: Column, km: Column) -> tuple[Column, Column]:
    """Flat-earth end point of a short way."""
    per_degree = math.pi * RADIUS_KM / 180
    return lat + km * F.cos(F.radians(bearing)) / per_degree, lon + km * F.sin(F.radians(bearing)) / (per_degree * F.cos(F.radians(lat)))


def path_part(x: Column) -> tuple[Column, Column]:
    """Whole degrees, cut toward zero, and two decimals, as paths have them."""
    return x.cast("int"), F.pmod(F.abs(x * PER_DEGREE), F.lit(100.0)).cast("int")


def partition_path(lat: Column, lon: Column) -> Column:
    (a, b), (c, d) = path_part(lat), path_part(lon)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.lit("lat_deg="), two(a), F.lit("/lon_deg="), c.cast("string"), F.lit("/lat_dec="), two(b), F.lit("/lon_dec="), two(d))


def cell(x: Column) -> Column:
    """Number of the grid cell, floored: the key of spatial joins."""
    return F.floor(x * PER_DEGREE).cast("long")


def grid_id(lat: Column, lon: Column) -> Column:
    """Id of the cell of a place in paths, from parts cut toward zero."""
    (a, b), (c, d) = path_part(lat), path_part(lon)
    return F.concat_ws("_", a.cast("string"), c.cast("string"), F.lpad(b.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))


def triangle_wkt(points: list[tuple[Column, Column]]) -> Column:
    pair = lambda p: F.format_string("%.6f %.6f", p[0], p[1])
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *(pair(p) for p in [*points, points[0]])), F.lit("))"))


def parse_polygon(wkt: Column) -> Column:
    """Array of (lon, lat) of a WKT polygon's outer ring."""
    ring = F.regexp_extract(wkt, r"\(\(([^)]*)\)", 1)
    return F.transform(F.split(ring, r"\s*,\s*"), lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("lon"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("lat")))


def in_triangle(px: Column, py: Column, a: tuple, b: tuple, c: tuple, slack: float = 1e-10) -> tuple[Column, list[Column]]:
    """Whether a point lies in a triangle, and its barycentric weights; a triangle without area holds nothing."""
    det = (b[1] - c[1]) * (a[0] - c[0]) + (c[0] - b[0]) * (a[1] - c[1])
    w1 = F.try_divide((b[1] - c[1]) * (px - c[0]) + (c[0] - b[0]) * (py - c[1]), det)
    w2 = F.try_divide((c[1] - a[1]) * (px - c[0]) + (a[0] - c[0]) * (py - c[1]), det)
    w3 = 1 - w1 - w2
    return F.coalesce((w1 >= -slack) & (w2 >= -slack) & (w3 >= -slack), F.lit(False)), [w1, w2, w3]


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column, Column]:
    """Planar distance from a point to a segment and the nearest place on it; a segment without length is a point."""
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    qx, qy = ax + t * dx, ay + t * dy
    return F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy)), qx, qy


def rectangle_distance(lat: Column, lon: Column, lat_min, lat_max, lon_min, lon_max) -> Column:
    """Distance in degrees from a place to a rectangle, 0 inside."""
    zero = F.lit(0.0)
    y = F.greatest(F.lit(lat_min) - lat, zero, lat - F.lit(lat_max))
    x = F.greatest(F.lit(lon_min) - lon, zero, lon - F.lit(lon_max))
    return F.sqrt(x * x + y * y)
