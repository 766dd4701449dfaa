"""Polygons at the dateline, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def eastward(ring: Column) -> Column:
    """A ring of (lon, lat) with western longitudes raised by 360 where it spans over 180 degrees."""
    lons = F.transform(ring, lambda p: p["lon"])
    moved = F.transform(ring, lambda p: F.struct(F.when(p["lon"] < 0, p["lon"] + 360).otherwise(p["lon"]).alias("lon"), p["lat"].alias("lat")))
    return F.when(F.array_max(lons) - F.array_min(lons) > 180, moved).otherwise(ring)


def clipped(ring: Column, limit: float, west: bool) -> Column:
    """The part of a ring on one side of a meridian: vertices on that side, and crossings of edges, in order."""
    nexts = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    edges = F.zip_with(ring, nexts, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    inside = lambda v: (v["lon"] <= limit) if west else (v["lon"] >= limit)

    def kept(e: Column) -> Column:
        p, q = e["p"], e["q"]
        t = F.try_divide(F.lit(limit) - p["lon"], q["lon"] - p["lon"])
        cross = F.struct(F.lit(limit).alias("lon"), (p["lat"] + t * (q["lat"] - p["lat"])).alias("lat"))
        own = F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))
        return F.array_compact(F.array(F.when(inside(p), own), F.when(inside(p) != inside(q), cross)))

    return F.flatten(F.transform(edges, kept))


def split_at_dateline(ring: Column, gap: float = 0.001) -> Column:
    """One ring, or two for a ring over the dateline, a gap apart on either side of it."""
    full = eastward(ring)
    lons = F.transform(full, lambda p: p["lon"])
    back = F.transform(clipped(full, 180 + gap / 2, west=False), lambda p: F.struct((p["lon"] - 360).alias("lon"), p["lat"].alias("lat")))
    over = (F.array_max(lons) > 180) & (F.array_min(lons) < 180)
    return F.when(over, F.array(clipped(full, 180 - gap / 2, west=True), back)).otherwise(F.array(ring))


def crosses(line: Column) -> Column:
    """Whether a line of (lon, lat) steps over the dateline: two following longitudes over 180 degrees apart."""
    later = F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0)))
    steps = F.zip_with(F.slice(line, 1, F.size(later)), later, lambda p, q: F.abs(q["lon"] - p["lon"]) > 180)
    return F.coalesce(F.exists(steps, lambda s: s), F.lit(False))


def band(line: Column, padding: float = 2.0) -> Column:
    """The ring around the earth between the least and greatest latitude of a line, padded: how a line over the dateline is closed."""
    lats = F.transform(line, lambda p: p["lat"])
    low, high = F.array_min(lats) - padding, F.array_max(lats) + padding
    return F.array(*(F.struct(F.lit(x).alias("lon"), y.alias("lat")) for x, y in ((-180.0, low), (180.0, low), (180.0, high), (-180.0, high))))
