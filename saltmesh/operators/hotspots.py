"""Energy hotspots: a greedy choice of strong, distant cells, each with the cells of a search area that no other has."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.scratch import kept

# Metres of a degree for the sides of a search area, the step by which the spacing shrinks, and the share of it that ends that.
METRES_PER_DEGREE = 111_000
SHRINK, LEAST_SHARE = 0.8, 0.3
#: Cells that come to the driver at once, strongest first.
CANDIDATES = 10_000


def _metres(a, b) -> float:
    la, lb = math.radians(a["lat"]), math.radians(b["lat"])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b["lon"] - a["lon"]) / 2) ** 2
    return 2 * geo.RADIUS_KM * 1000 * math.asin(math.sqrt(min(h, 1.0)))


def _free(c, spacing: float, half: float) -> Column:
    """Cells that a chosen one leaves free: far enough, and outside its search area."""
    far = geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(c["lat"]), F.lit(c["lon"])) * 1000 >= spacing
    return far & (F.col("face") != c["face"]) & ~((F.abs(F.col("lat") - c["lat"]) <= half) & (F.abs(F.col("lon") - c["lon"]) <= half))


def hotspots(cells: DataFrame, spacing_m: float, top: int, area_m2: float, candidates: int = CANDIDATES) -> DataFrame:
    """(rank, face, lat, lon, power, lat_min, lat_max, lon_min, lon_max, n, total, mean, nearest_m) of cells (face, lat, lon, power).

    By falling power (ties to the smaller face), a cell is chosen that no search area of one chosen before holds and that is spacing_m
    from all of those. The cells in the square about it, without those of an earlier one, are its own. While there are fewer than top, the
    spacing shrinks by a fifth and all cells are gone through again, until it is under 0.3 of what it was. Cells without power are left
    out; nearest_m is null for a single one.

    The cells are computed once. Each pass filters out what the chosen exclude and brings the strongest of the rest, a bounded number,
    to the driver, which goes on where the last pass ended; so passes follow how often that number is not enough, not top."""
    faces = kept(cells.select("face", "lat", "lon", "power").where("power is not null and not isnan(power)"), "powers")
    half, chosen, spacing = math.sqrt(area_m2) / METRES_PER_DEGREE / 2, [], spacing_m
    inside = lambda c, x: abs(x["lat"] - c["lat"]) <= half and abs(x["lon"] - c["lon"]) <= half
    while True:
        last = None
        while len(chosen) < top:
            left = faces
            for c in chosen:
                left = left.where(_free(c, spacing, half))
            if last:
                left = left.where((F.col("power") < last["power"]) | ((F.col("power") == last["power"]) & (F.col("face") > last["face"])))
            found = left.orderBy(F.desc("power"), "face").limit(candidates).collect()
            for x in found:
                if len(chosen) < top and all(_metres(x, c) >= spacing and x["face"] != c["face"] and not inside(c, x) for c in chosen):
                    chosen.append(x)
            if len(found) < candidates:
                break
            last = found[-1]
        if len(chosen) >= top or spacing <= LEAST_SHARE * spacing_m:
            break
        spacing *= SHRINK
    nearest = [min((_metres(a, b) for b in chosen if b is not a), default=None) for a in chosen]
    rows = [(k + 1, c["face"], c["lat"], c["lon"], c["power"], c["lat"] - half, c["lat"] + half, c["lon"] - half, c["lon"] + half, m) for k, (c, m) in enumerate(zip(chosen, nearest, strict=True))]
    at = cells.sparkSession.createDataFrame(rows, "rank int, face long, lat double, lon double, power double, lat_min double, lat_max double, lon_min double, lon_max double, nearest_m double")
    return at.join(_claimed(at, faces), "rank").select("rank", "face", "lat", "lon", "power", "lat_min", "lat_max", "lon_min", "lon_max", "n", "total", "mean", "nearest_m")


def _claimed(at: DataFrame, faces: DataFrame) -> DataFrame:
    """(rank, n, total, mean): cells of each area, those that several hold going to the first. A centre is no one's to claim: it counts in every area about it. The few areas mark grid cells, which join by equality."""
    span = lambda c: F.explode(F.sequence(geo.cell(F.col(f"{c}_min")), geo.cell(F.col(f"{c}_max"))))
    marks = at.select("rank", F.col("face").alias("centre"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "lat_min", "lat_max", "lon_min", "lon_max")
    half = (F.col("lat_max") - F.col("lat_min")) / 2
    marks = marks.withColumn("_half", half).withColumn("cy", span("lat")).withColumn("cx", span("lon"))
    cells = faces.withColumns({"cy": geo.cell(F.col("lat")), "cx": geo.cell(F.col("lon"))})
    met = cells.join(F.broadcast(marks), ["cy", "cx"]).where((F.abs(F.col("lat") - F.col("_lat")) <= F.col("_half")) & (F.abs(F.col("lon") - F.col("_lon")) <= F.col("_half")))
    centres = at.select(F.col("face"), F.lit(True).alias("is_centre"))
    met = met.join(F.broadcast(centres), "face", "left").withColumn("first", F.min("rank").over(Window.partitionBy("face")))
    return met.where("rank = first or is_centre").groupBy("rank").agg(F.count("*").alias("n"), F.sum("power").alias("total"), F.avg("power").alias("mean"))
