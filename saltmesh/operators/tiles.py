"""Nearest places by a tree of tiles: bounded leaves with tight boxes, looked up level by level under a bound that shrinks.

Places are put in the order of a space-filling curve and cut into runs: a leaf has LEAF of them at most, and a node FAN nodes,
however dense they lie. Queries start at the few nodes on top. At each level the greatest distance to a box bounds the nearest
place of a query, and only boxes whose least distance is within the bound are opened. So a query far from one dense cluster
meets the leaves on its near side, about as many as the root of all, and one inside of it those around it.

Segments are cut into pieces first, so that boxes are tight however long they are, and are looked up for blocks of points that lie
together: the tree is gone down once for a block, and its points meet each segment that they may be nearest to once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.scratch import kept
from ..sources.tables import numbered

#: Places of a leaf, nodes of a node, nodes that are broadcast.
LEAF, FAN, BROADCAST_NODES = 128, 64, 100_000
BOX = ("lat1", "lat2", "lon1", "lon2")
QUERY = ["qid", "qlat", "qlon"]
#: Pieces of a leaf, pieces for each segment on average at most, and of one segment.
PIECES, CUTS, MOST_CUTS = 32, 32, 100_000
#: Points of a block, pieces that a group may meet, and segments that are held against a block at once.
BLOCK, MET, AT_ONCE = 64, 65_536, 2_048
BLOCKS = ["block", "south", "north", "west", "east"]


@dataclass
class Tiles:
    """Items with their leaf, and the nodes (node, parent, boxes, n) of each level, leaves first."""

    items: DataFrame
    levels: list[DataFrame]
    sizes: list[int]


def _spread(x: Column) -> Column:
    """31 bits, with a zero between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve(lat: Column, lon: Column) -> Column:
    """Place on a space-filling curve of some centimetres."""
    bits = lambda x, span: F.least(F.floor(x / span * 2**31), F.lit(2**31 - 1)).cast("long")
    return _spread(bits(lat + 90, 180.0)).bitwiseOR(F.shiftleft(_spread(bits(F.pmod(lon, F.lit(360.0)), 360.0)), 1))


def packed(items: DataFrame, order: list[str], leaf: int = LEAF, fan: int = FAN) -> Tiles:
    """Tiles of items with a box, in the order given: one range sort, then counts of runs."""
    # The order is stored; only places in it are computed again.
    found = numbered(items, order).withColumn("node", F.floor(F.col("position") / leaf)).drop("position")
    boxes = [f(c).alias(c) for f, c in zip((F.min, F.max, F.min, F.max), BOX, strict=True)]
    leaves = kept(found.groupBy("node").agg(*boxes, F.count("*").alias("n")).withColumn("parent", F.floor(F.col("node") / fan)), "leaves")
    levels, sizes = [leaves], [leaves.count()]
    while sizes[-1] > fan:
        above = levels[-1].groupBy(F.col("parent").alias("node")).agg(*boxes, F.sum("n").alias("n")).withColumn("parent", F.floor(F.col("node") / fan))
        levels.append(kept(above, "nodes"))
        sizes.append(-(-sizes[-1] // fan))
    return Tiles(found, levels, sizes)


def _bounded(frontier: DataFrame, k: int, reach: Callable[[], tuple[Column, Column]], query: list[str]) -> DataFrame:
    """Nodes that may hold one of the k nearest: the boxes that are sure to hold k places, nearest first by their far sides, bound the rest."""
    low, high = reach()
    rows = frontier.withColumns({"_low": low, "_high": high})
    if k == 1:
        sure = F.min("_high").over(Window.partitionBy(*query))
    else:
        upto = Window.partitionBy(*query).orderBy("_high", "node").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_sum", F.sum("n").over(upto))
        sure = F.min(F.when(F.col("_sum") >= k, F.col("_high"))).over(Window.partitionBy(*query))
    rows = rows.withColumn("_bound", F.least("_bound", sure))
    return rows.where(F.col("_low") <= F.col("_bound") * (1 + 1e-9) + 1e-9).select(*query, "node", "_bound")


def candidates(queries: DataFrame, tiles: Tiles, k: int, reach: Callable[[], tuple[Column, Column]], query: list[str] = QUERY) -> DataFrame:
    """(qid, qlat, qlon, node), or other columns of a query: the leaves that may hold one of the k nearest of each query. reach gives the least and greatest distance of (qlat, qlon) to a box. At most FAN nodes, those on top, come to the driver."""
    top = tiles.levels[-1].select("node", *BOX, "n").collect()
    if not top:
        return queries.withColumn("node", F.lit(0).cast("long")).limit(0)
    roots = F.array(*(F.struct(*(F.lit(r[c]).alias(c) for c in ("node", *BOX, "n"))) for r in top))
    frontier = queries.withColumns({"_bound": F.lit(float("inf")), "_r": F.explode(roots)}).select(*query, "_bound", "_r.*")
    for below, size in zip(tiles.levels[-2::-1], tiles.sizes[-2::-1], strict=True):
        opened = _bounded(frontier, k, reach, query).withColumnRenamed("node", "parent")
        nodes = below.select("parent", "node", *BOX, "n")
        frontier = opened.join(F.broadcast(nodes) if size <= BROADCAST_NODES else nodes.hint("merge"), "parent")
    return _bounded(frontier, k, reach, query).drop("_bound")


def _east() -> tuple[Column, Column]:
    """Least and greatest degrees of longitude from qlon to a box, the short way around the earth."""
    turned = [F.col("qlon") + s for s in (-360.0, 0.0, 360.0)]
    least = F.least(*(F.greatest(F.col("lon1") - x, x - F.col("lon2"), F.lit(0.0)) for x in turned))
    most = F.least(*(F.greatest(F.abs(x - F.col("lon1")), F.abs(x - F.col("lon2"))) for x in turned))
    return least, most


def _north() -> tuple[Column, Column]:
    return F.greatest(F.col("lat1") - F.col("qlat"), F.col("qlat") - F.col("lat2"), F.lit(0.0)), F.greatest(F.abs(F.col("qlat") - F.col("lat1")), F.abs(F.col("qlat") - F.col("lat2")))


def reach_degrees(shrink: Callable[[], Column] = lambda: F.lit(1.0)) -> Callable[[], tuple[Column, Column]]:
    """Planar distances in degrees, longitudes times shrink."""

    def reach() -> tuple[Column, Column]:
        (x1, x2), (y1, y2), k = _east(), _north(), shrink()
        return F.sqrt(y1**2 + (k * x1) ** 2), F.sqrt(y2**2 + (k * x2) ** 2)

    return reach


def reach_km() -> tuple[Column, Column]:
    """Distances on the sphere, the tighter of two bounds: the haversine of the least and greatest steps with the least and greatest width of the box's circles of latitude, and the distance to the middle of the box less or more its radius."""
    (x1, x2), (y1, y2) = _east(), _north()
    ends = F.cos(F.radians("lat1")), F.cos(F.radians("lat2"))
    widest = F.when((F.col("lat1") <= 0) & (F.col("lat2") >= 0), 1.0).otherwise(F.greatest(*ends))
    lat, lon = (F.col("lat1") + F.col("lat2")) / 2, (F.col("lon1") + F.col("lon2")) / 2

    def km(y: Column, x: Column, own: Column, width: Column) -> Column:
        h = F.sin(F.radians(y) / 2) ** 2 + F.greatest(own * width, F.lit(0.0)) * F.sin(F.radians(F.least(x, F.lit(180.0))) / 2) ** 2
        return 2 * geo.RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))

    own = F.cos(F.radians("qlat"))
    middle = geo.haversine_km(F.col("qlat"), F.col("qlon"), lat, lon)
    radius = km((F.col("lat2") - F.col("lat1")) / 2, (F.col("lon2") - F.col("lon1")) / 2, F.cos(F.radians(lat)), widest) + 1e-9
    return F.greatest(km(y1, x1, own, F.least(*ends)), middle - radius), F.least(km(y2, x2, own, widest), middle + radius)


def _placed(rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return rows.where(f"{lat} is not null and {lon} is not null and not isnan({lat}) and not isnan({lon})")


def _query_places(queries: DataFrame) -> DataFrame:
    return _placed(queries).select("qid", F.col("lat").cast("double").alias("qlat"), F.col("lon").cast("double").alias("qlon"))


def tiles_of_points(points: DataFrame, k: int) -> Tiles:
    """Tiles of points (face, lat, lon). Of a place that repeats, the k smallest faces stay: no more can be among the nearest."""
    rows = _placed(points).select("face", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    if k == 1:
        rows = rows.groupBy("lat", "lon").agg(F.min("face").alias("face"))
    else:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("lat", "lon").orderBy("face"))).where(F.col("_n") <= k).drop("_n")
    rows = rows.withColumns({"lat1": F.col("lat"), "lat2": F.col("lat"), "lon1": F.col("lon"), "lon2": F.col("lon"), "_z": curve(F.col("lat"), F.col("lon"))})
    return packed(rows, ["_z", "lat", "lon", "face"])


def nearest(queries: DataFrame, points: DataFrame) -> DataFrame:
    """(qid, face, km) of the nearest point (face, lat, lon) of every query (qid, lat, lon), however far, ties to the smaller face. Queries and points without a place take no part."""
    tiles = tiles_of_points(points, 1)
    met = candidates(_query_places(queries), tiles, 1, reach_km).join(tiles.items.select("node", "face", "lat", "lon"), "node")
    km = geo.haversine_km(F.col("qlat"), F.col("qlon"), F.col("lat"), F.col("lon"))
    best = met.withColumn("km", km).groupBy("qid").agg(F.min(F.struct("km", "face")).alias("best"))
    return best.select("qid", "best.face", "best.km")


def nearest_k(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """The k nearest (or all, if there are fewer points) by planar distance in degrees, the short way around the earth."""
    tiles = tiles_of_points(points, k)
    met = candidates(_query_places(queries), tiles, k, reach_degrees()).join(tiles.items.select("node", "face", "lat", "lon"), "node")
    east = F.col("lon") - F.col("qlon")
    east = F.when(F.abs(east) <= 180, east).otherwise(geo.wrapped(east))
    met = met.withColumn("deg", F.sqrt((F.col("lat") - F.col("qlat")) ** 2 + east**2))
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("deg", "face")))
    return ranked.where(F.col("rank") <= k).select("qid", "rank", "face", "deg")


def tiles_of_segments(coast: DataFrame, leaf: int = PIECES) -> Tiles:
    """Tiles of the pieces of segments (x1, y1, x2, y2), each segment once; one over the dateline goes the short way. Pieces are about half as long as the middles of a leaf's segments usually lie apart, and not more than CUTS for each segment on average."""
    rows = coast.select("x1", "y1", "x2", "y2").where("x1 * 0 = 0 and y1 * 0 = 0 and x2 * 0 = 0 and y2 * 0 = 0").distinct()  # no nulls, NaN or infinite ends
    east, north = _short(F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")
    mid = {"_y": F.col("y1") + north / 2, "_x": F.pmod(F.col("x1") + east / 2, F.lit(360.0))}
    rows = rows.withColumns({"_east": east, "_north": north, "_long": F.sqrt(east * east + north * north)} | mid).withColumn("_z", curve(F.col("_y"), F.col("_x")))
    rows = numbered(rows, ["_z", "x1", "y1", "x2", "y2"])
    wide = F.greatest(F.max("_x") - F.min("_x"), F.max("_y") - F.min("_y"))
    runs = rows.groupBy(F.floor(F.col("position") / leaf)).agg(F.count("*").alias("n"), F.sum("_long").alias("long"), wide.alias("wide"))
    runs = runs.agg(F.sum("n").alias("n"), F.sum("long").alias("long"), F.percentile_approx("wide", 0.5).alias("wide")).first()
    step = max(runs["long"] / (CUTS * runs["n"]), runs["wide"] / 2) if runs["n"] else 0.0
    cuts = F.least(F.greatest(F.ceil(F.col("_long") / step), F.lit(1)), F.lit(MOST_CUTS)) if step else F.lit(1)
    rows = rows.withColumn("_n", cuts).withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)))
    (x, x_), (y, y_) = [[F.col(c) + (F.col("_j") + k) / F.col("_n") * F.col(d) for k in (0, 1)] for c, d in (("x1", "_east"), ("y1", "_north"))]
    west = F.pmod(F.least(x, x_), F.lit(360.0))
    rows = rows.withColumns({"lat1": F.least(y, y_), "lat2": F.greatest(y, y_), "lon1": west, "lon2": west + F.abs(x_ - x)})
    rows = rows.select("x1", "y1", "x2", "y2", "_j", *BOX, curve((F.col("lat1") + F.col("lat2")) / 2, (F.col("lon1") + F.col("lon2")) / 2).alias("_z"))
    return packed(rows, ["_z", "x1", "y1", "x2", "y2", "_j"], leaf=leaf)


def _short(east: Column) -> Column:
    """A step of longitude, the short way around the earth."""
    return F.when(F.abs(east) > 180, geo.wrapped(east)).otherwise(east)


def _reach_blocks() -> tuple[Column, Column]:
    """Planar distances in degrees of any place of a block to a box, the short way around the earth, longitudes shrunk as they are at the least and most within the block."""
    turned = [(F.col("west") + s, F.col("east") + s) for s in (-360.0, 0.0, 360.0)]
    x1 = F.least(*(F.greatest(F.col("lon1") - e, w - F.col("lon2"), F.lit(0.0)) for w, e in turned))
    x2 = F.least(*(F.greatest(F.col("lon2") - w, e - F.col("lon1")) for w, e in turned))
    y1 = F.greatest(F.col("lat1") - F.col("north"), F.col("south") - F.col("lat2"), F.lit(0.0))
    y2 = F.greatest(F.col("lat2") - F.col("south"), F.col("north") - F.col("lat1"))
    ends = F.cos(F.radians("south")), F.cos(F.radians("north"))
    widest = F.when((F.col("south") <= 0) & (F.col("north") >= 0), 1.0).otherwise(F.greatest(*ends))
    return F.sqrt(y1**2 + (F.least(*ends) * x1) ** 2), F.sqrt(y2**2 + (widest * x2) ** 2)


def _nearest_of_block(points: pa.Table, coast: pa.Table) -> pa.Table:
    """The points of a block with the distance d and the nearest place (sy, sx) of some segments; of places as near, the southern and western one. Segments are taken some at a time."""
    lat, lon = (points[c].to_numpy()[:, None] for c in ("qlat", "qlon"))
    k, best = np.cos(np.radians(lat)), np.full((3, len(lat)), np.inf)
    for at in range(0, coast.num_rows, AT_ONCE):
        x1, y1, x2, y2 = (coast[c].slice(at, AT_ONCE).to_numpy()[None, :] for c in ("x1", "y1", "x2", "y2"))
        east, north = x2 - x1, y2 - y1
        east = np.where(np.abs(east) > 180, (east + 180) % 360 - 180, east)
        off = x1 - lon
        off = off - np.round(off / 360) * 360
        # A segment that reaches far round may be nearer a turn on, or back.
        ways = (0.0,) if np.all(np.abs(off) + np.abs(east) < 180) else (-360.0, 0.0, 360.0)
        dx = east * k
        length = dx * dx + north * north
        length[length == 0] = np.inf  # no way along: the nearest place is the first end
        for more in ways:
            ax, ay = (off + more) * k, y1 - lat
            t = np.clip(-(ax * dx + ay * north) / length, 0.0, 1.0)
            d, sy, sx = np.sqrt((ax + t * dx) ** 2 + (ay + t * north) ** 2), y1 + t * north, x1 + t * east
            found = [d.min(axis=1)]
            tied = d == found[0][:, None]
            found.append(np.where(tied, sy, np.inf).min(axis=1))
            found.append(np.where(tied & (sy == found[1][:, None]), sx, np.inf).min(axis=1))
            (a, b, c), (p, q, r) = found, best
            best = np.where((a < p) | ((a == p) & ((b < q) | ((b == q) & (c < r)))), found, best)
    return pa.table({c: points[c] for c in QUERY} | dict(zip(("d", "sy", "sx"), best, strict=True)))


def nearest_shore(points: DataFrame, coast: DataFrame, snap_km: float = 2.0) -> DataFrame:
    """(qid, km, shore_lat, shore_lon): nearest place on coast segments (x1, y1, x2, y2) to every point, however far, by planar distance with longitudes shrunk at the point's latitude, the short way around the earth; nulls if there is no coast. Distances are on the sphere, snapped to 0 below snap_km."""
    tiles = tiles_of_segments(coast)
    kind = dict(points.dtypes)["qid"]
    placed = _query_places(points).withColumn("_z", curve(F.col("qlat"), F.col("qlon")))
    placed = numbered(placed, ["_z", "qlat", "qlon", "qid"]).select(*QUERY, F.floor(F.col("position") / BLOCK).alias("block"))
    turn = F.pmod("qlon", F.lit(360.0))
    blocks = placed.groupBy("block").agg(F.min("qlat").alias("south"), F.max("qlat").alias("north"), F.min(turn).alias("west"), F.max(turn).alias("east"))
    # Points meet the segments of their block in as many groups as bound what one of them holds.
    groups = F.ceil(F.count("*").over(Window.partitionBy(*BLOCKS)) * PIECES / MET)
    pairs = kept(candidates(blocks, tiles, 1, _reach_blocks, BLOCKS).select("block", "node", groups.alias("groups")), "met")
    ends = ["x1", "y1", "x2", "y2"]
    met = pairs.hint("merge").join(tiles.items.select("node", *ends), "node").select("block", F.pmod(F.xxhash64(*ends), "groups").alias("group"), *ends)
    met = met.repartition("block", "group").distinct()  # dealt once, for both this and the groups
    own = placed.join(pairs.select("block", "groups").distinct().hint("merge"), "block")
    own = own.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), *QUERY)
    found = own.groupBy("block", "group").cogroup(met.groupBy("block", "group")).applyInArrow(_nearest_of_block, f"qid {kind}, qlat double, qlon double, d double, sy double, sx double")
    best = found.groupBy(*QUERY).agg(F.min(F.struct("d", "sy", "sx")).alias("b"))
    km = geo.haversine_km(F.col("qlat"), F.col("qlon"), F.col("b.sy"), F.col("b.sx"))
    sx = F.when(F.abs(F.col("b.sx")) <= 180, F.col("b.sx")).otherwise(geo.wrapped(F.col("b.sx")))
    found = best.select("qid", F.when(km < snap_km, 0.0).otherwise(km).alias("km"), F.col("b.sy").alias("shore_lat"), sx.alias("shore_lon"))
    return points.select("qid").join(found, "qid", "left")


def within_limit(found: DataFrame, metres: float) -> DataFrame:
    return found.withColumn("ok", F.col("km") * 1000 <= metres)


def lines_cells(segments: DataFrame, most: float) -> DataFrame:
    """segments (sid, lat1, lon1, lat2, lon2) with the grid cells (cy, cx) whose centre may be at most so many degrees from them, row by row: each row of cells has its own stretch of columns, so that a line marks cells in proportion to its length."""
    per, reach = geo.PER_DEGREE, most + 1.0 / geo.PER_DEGREE
    row = lambda y: F.floor(y * per).cast("long")
    rows = segments.withColumn("cy", F.explode(F.sequence(row(F.least("lat1", "lat2") - reach), row(F.greatest("lat1", "lat2") + reach))))
    # Where the segment is within reach of the row, as shares of its length.
    low, high = F.col("cy") / per - reach, (F.col("cy") + 1) / per + reach
    rise = F.col("lat2") - F.col("lat1")
    at = [(y - F.col("lat1")) / F.nullif(rise, F.lit(0.0)) for y in (low, high)]
    first = F.greatest(F.coalesce(F.least(*at), F.lit(0.0)), F.lit(0.0))
    last = F.least(F.coalesce(F.greatest(*at), F.lit(1.0)), F.lit(1.0))
    x = [F.col("lon1") + s * (F.col("lon2") - F.col("lon1")) for s in (first, last)]
    span = F.sequence(row(F.least(*x) - reach), row(F.greatest(*x) + reach))
    return rows.where(first <= last).withColumn("cx", F.explode(span))
