"""Polygons as cells of an adaptive quadtree, and points in polygons by a join on those cells.

A polygon starts with the few cells as large as its box. Cells with many edges are divided, level by level. A cell that no
edge touches lies inside or outside as a whole; any other keeps the edges that touch it, and a start for the parity of the
edges to the east. So a point meets one cell of each polygon near it, and in it a bounded number of edges.

The start rests on this: edges that don't touch a cell form chains, which end within its rows only where they meet edges that do.
To the east of the cell a chain crosses a latitude as often, in parity, as its ends say, whatever it does between them. So the
parity of all other edges is a constant of the cell, changed by the far ends of its own edges that are above the point; these are
comparisons of coordinates alone, and the answer is that of a ray through all edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import broadcast_if_few, kept

#: Edges that a cell may keep undivided, and the finest level; there a cell keeps all edges that touch it.
LEAF, FINEST = 16, 20
#: Degrees by which cells are widened, so that rounding loses no edge and no point.
WIDER = 1e-10
#: Degrees within which a point is on an edge but for rounding; less than WIDER, so that its cell has the edge.
NEAR = 1e-11
#: Cells that are broadcast.
BROADCAST_CELLS = 200_000
CELL = ["pid", "level", "cy", "cx"]


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """polygons (pid, ring array<struct<lon,lat>>) to (pid, x1, y1, x2, y2)."""
    r = F.col("ring")
    ends = F.zip_with(r, F.concat(F.slice(r, 2, F.size(r) - 1), F.slice(r, 1, 1)), lambda a, b: F.struct(a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")))
    return polygons.where(F.size(r) > 0).select("pid", F.explode(ends).alias("e")).select("pid", "e.*")


def _side(level: Column) -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), level)


def _index(x: Column, level: Column) -> Column:
    return F.floor((x + 180) / _side(level)).cast("long")


def _crosses(e: dict[str, Column], x: Column, y: Column) -> Column:
    """Whether an edge crosses the latitude of a point to the east of it."""
    spans = (e["y1"] > y) != (e["y2"] > y)
    return spans & F.coalesce(x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"], F.lit(False))


def _far_ends(e: dict[str, Column], east: Column, y: Column) -> Column:
    """Parity of the ends of an edge that are east of a cell and above a latitude."""
    return ((e["x1"] > east) & (e["y1"] > y)) != ((e["x2"] > east) & (e["y2"] > y))


def _touches(e: dict[str, Column], x: Column, y: Column, half: Column) -> Column:
    """Whether an edge meets the square about (x, y): neither axis nor the edge's normal parts them."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    apart = F.abs(dy * (x - e["x1"]) - dx * (y - e["y1"])) > half * (F.abs(dx) + F.abs(dy))
    beside = lambda a, b, c: (F.least(a, b) > c + half) | (F.greatest(a, b) < c - half)
    return ~(apart | beside(e["x1"], e["x2"], x) | beside(e["y1"], e["y2"], y))


def _divided(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells (pid, level, cy, cx, parity, n) and their edges from edges with the cell they are for, and with the parity and eastern bound (start, east) of the cell that is divided."""
    e = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    half = _side(F.col("level")) / 2
    x, y = F.col("cx") * _side(F.col("level")) - 180 + half, F.col("cy") * _side(F.col("level")) - 180 + half
    there = edges.withColumn("own", _touches(e, x, y, half + WIDER))
    # At the middle of the cell: all edges of the divided cell tell whether it is inside, its own edges are then taken out.
    seen = _crosses(e, x, y) != _far_ends(e, F.col("east"), y)
    mine = F.col("own") & (_crosses(e, x, y) != _far_ends(e, x + half + WIDER, y))
    there = kept(there.withColumn("flip", (seen != mine).cast("int")), "cover")
    cells = there.groupBy(*CELL).agg(F.max("start").alias("start"), F.bit_xor("flip").alias("flips"), F.sum(F.col("own").cast("long")).alias("n"))
    cells = kept(cells.select(*CELL, F.col("start").bitwiseXOR(F.col("flips")).alias("parity"), "n"), "cells")
    return cells, there.where("own").select(*CELL, *e)


def covering(polygons: DataFrame, leaf: int = LEAF, finest: int = FINEST) -> DataFrame:
    """(pid, level, cy, cx, parity, edges) of polygons (pid, ring): the cells that are inside or on the boundary. Rings of one pid are one polygon, by parity. A cell within keeps no edges and has the parity 1."""
    edges = polygon_edges(polygons).where("x1 <> x2 or y1 <> y2")
    boxes = edges.groupBy("pid").agg(*(f(g(f"{c}1", f"{c}2")).alias(f"{c}{n}") for c in "xy" for n, f, g in (("lo", F.min, F.least), ("hi", F.max, F.greatest))))
    wide = F.greatest(F.col("xhi") - F.col("xlo"), F.col("yhi") - F.col("ylo"), _side(F.lit(finest)))
    boxes = boxes.withColumn("level", F.greatest(F.least(F.floor(F.log2(F.lit(360.0) / wide)), F.lit(finest)), F.lit(0)).cast("int"))
    span = lambda c: F.sequence(_index(F.col(f"{c}lo") - WIDER, F.col("level")), _index(F.col(f"{c}hi") + WIDER, F.col("level")))
    first = edges.join(boxes, "pid").withColumn("cy", F.explode(span("y"))).withColumn("cx", F.explode(span("x")))
    first = first.select(*CELL, "x1", "y1", "x2", "y2", F.lit(0).alias("start"), F.lit(float("inf")).alias("east"))
    done = []
    while True:
        cells, own = _divided(first)
        big = cells.where((F.col("n") > leaf) & (F.col("level") < finest))
        more = not big.isEmpty()
        ready = cells.where((F.col("n") <= leaf) | (F.col("level") >= finest)).where("n > 0 or parity = 1") if more else cells.where("n > 0 or parity = 1")
        lists = own.groupBy(*CELL).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
        none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
        done.append(ready.join(lists, CELL, "left").select(*CELL, "parity", F.coalesce("edges", none).alias("edges")))
        if not more:
            return kept(reduce(DataFrame.unionByName, done), "covering")
        parents = own.join(big.select(*CELL, "parity"), CELL)
        east = (F.col("cx") + 1) * _side(F.col("level")) - 180 + WIDER
        quarter = F.explode(F.array(*(F.struct((F.col("cy") * 2 + a).alias("cy"), (F.col("cx") * 2 + b).alias("cx")) for a in (0, 1) for b in (0, 1))))
        first = parents.select("pid", (F.col("level") + 1).alias("level"), quarter.alias("q"), "x1", "y1", "x2", "y2", F.col("parity").alias("start"), east.alias("east"))
        first = first.select("pid", "level", "q.cy", "q.cx", "x1", "y1", "x2", "y2", "start", "east")


def containing(points: DataFrame, polygons: DataFrame, leaf: int = LEAF, finest: int = FINEST, on_edge: Column | None = None) -> DataFrame:
    """(qid, pid) of points (qid, lat, lon) in polygons (pid, ring), one row for each row of points and polygon that holds it. Points without a place are in none. Whether a polygon holds points on its edges is rounding, or what on_edge says, a condition on lat, lon and columns of polygons. Each level of cells that the covering has is looked up by equality; a hot cell's points are split by the broadcast or the skew join."""
    cover = covering(polygons, leaf, finest)
    levels = sorted(r["level"] for r in cover.select("level").distinct().collect())  # finest + 1 at most
    few = cover.count() <= BROADCAST_CELLS
    at = points.where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)").select("qid", "lat", "lon")
    at = at.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    at = at.withColumns({"cy": _index(F.col("lat"), F.col("level")), "cx": _index(F.col("lon"), F.col("level"))})
    met = at.join(F.broadcast(cover) if few else cover, ["level", "cy", "cx"])
    east = (F.col("cx") + 1) * _side(F.col("level")) - 180 + WIDER

    def flipped(parity: Column, edge: Column) -> Column:
        e = {c: edge[c] for c in ("x1", "y1", "x2", "y2")}
        return parity.bitwiseXOR((_crosses(e, F.col("lon"), F.col("lat")) != _far_ends(e, east, F.col("lat"))).cast("int"))

    inside = F.aggregate("edges", F.col("parity"), flipped) == 1
    if on_edge is None:
        return met.where(inside).select("qid", "pid")
    near = F.exists("edges", lambda e: _touches({c: e[c] for c in ("x1", "y1", "x2", "y2")}, F.col("lon"), F.col("lat"), F.lit(NEAR)))
    met = met.select("qid", "pid", "lat", "lon", inside.alias("_in"), near.alias("_near")).where("_in or _near")
    rules = broadcast_if_few(polygons.withColumnRenamed("pid", "_pid"))
    return met.join(rules, (F.col("pid") == F.col("_pid")) & F.when(F.col("_near"), on_edge).otherwise(F.col("_in")), "left_semi").select("qid", "pid")

