"""Lookups and spatial joins over grid cells: equi-joins on cells with an exact condition after them, never a cross join of two large tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dateline, geo, names
from ..sources.scratch import broadcast_if_few
from .cover import containing
from .rings import convex_hull
from .tiles import lines_cells


def with_cell(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return points.withColumn("cy", geo.cell(F.col(lat))).withColumn("cx", geo.cell(F.col(lon)))


def closest_faces(points: DataFrame, lat: float, lon: float, n: int) -> DataFrame:
    """n closest to one place: a top-k, no sort of the table."""
    d = F.sqrt((F.col("lat") - lat) ** 2 + (F.col("lon") - lon) ** 2)
    return points.withColumn("deg", d).orderBy("deg", "face").limit(n)


def grid_index(points: DataFrame) -> DataFrame:
    """Cells with bounds, centre, number of points and the points in order."""
    cells = with_cell(points).groupBy("cy", "cx").agg(F.count("*").alias("n_points"), F.array_sort(F.collect_list(F.struct("face", "lat", "lon"))).alias("points"))
    per = geo.PER_DEGREE
    return cells.withColumns({
        "lat_min": F.col("cy") / per, "lat_max": (F.col("cy") + 1) / per, "lon_min": F.col("cx") / per, "lon_max": (F.col("cx") + 1) / per,
        "centroid_lat": (F.col("cy") + 0.5) / per, "centroid_lon": (F.col("cx") + 0.5) / per,
    })


def face_index(points: DataFrame, dataset: str, period: str) -> DataFrame:
    """(location, face, lat, lon, path) of points (location, face, lat, lon), in ranges of location and face, so that a stored index is read only where a face can be."""
    file = names.point_file(F.col("location"), F.lit(dataset), F.col("face"), F.col("lat"), F.col("lon"), F.lit(period))
    path = F.concat_ws("/", "location", geo.partition_path(F.col("lat"), F.col("lon")), file)
    return points.select("location", "face", "lat", "lon", path.alias("path")).repartitionByRange("location", "face").sortWithinPartitions("location", "face")


def coarser(cells: DataFrame, degrees: float) -> DataFrame:
    """Cells gathered to boxes: number and envelope."""
    box = lambda c: (F.floor(F.col(c) / degrees) * degrees)
    return cells.groupBy(box("centroid_lat").alias("box_lat"), box("centroid_lon").alias("box_lon")).agg(
        F.count("*").alias("n_cells"), F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), F.min("lon_min").alias("lon_min"), F.max("lon_max").alias("lon_max")
    )


def in_rectangle(cells: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float, buffer: float = 0.0) -> DataFrame:
    """Cells whose centre lies in a rectangle or at most buffer degrees from it. Whole degrees come first, for partition pruning."""
    near = F.col("centroid_lat").between(lat_min - buffer, lat_max + buffer) & F.col("centroid_lon").between(lon_min - buffer, lon_max + buffer)
    return cells.where(near & (geo.rectangle_distance(F.col("centroid_lat"), F.col("centroid_lon"), lat_min, lat_max, lon_min, lon_max) <= buffer))


def along_segments(cells: DataFrame, segments: DataFrame, most: float, max_points: int | None = None) -> DataFrame:
    """Cells at most so many degrees from segments (sid, lat1, lon1, lat2, lon2), with the way along; of each segment the max_points closest to six places, if given, ties to the smaller cell. Segments mark the cells along them, which join cells by equality."""
    d, qx, qy = geo.segment_distance(F.col("centroid_lon"), F.col("centroid_lat"), F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    # Each segment marks hundreds of cells, which no estimate of its table tells: they stay where they are or are shuffled, never broadcast.
    dealt = segments.repartition(int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sid")
    marked = lines_cells(dealt, most).hint("merge")
    out = marked.join(broadcast_if_few(cells), ["cy", "cx"]).withColumn("off", d).withColumn("along", F.sqrt((qx - F.col("lon1")) ** 2 + (qy - F.col("lat1")) ** 2)).where(F.col("off") <= most)
    if max_points is None:
        return out
    ranked = out.withColumn("_n", F.row_number().over(Window.partitionBy("sid").orderBy(F.round("off", 6), "cy", "cx")))
    return ranked.where(F.col("_n") <= max_points).drop("_n")


def jurisdiction_flags(points: DataFrame, inside: DataFrame, layers: DataFrame) -> DataFrame:
    """points with flags of the layers (pid, layer, name) that hold them, and the names in order."""
    hit = inside.join(layers, "pid")
    flag = lambda layer: F.coalesce(F.bool_or(F.col("layer") == layer), F.lit(False)).alias(layer)
    agg = hit.groupBy("qid").agg(*(flag(x) for x in ("state", "ts", "eez", "cz")), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))
    return points.join(agg, "qid", "left").fillna(False, ["state", "ts", "eez", "cz"]).fillna("", ["names"])


def jurisdiction(state: Column, ts: Column, eez: Column, cz: Column) -> Column:
    return F.when(state, "State waters").when(ts, "Territorial sea").when(cz, "Contiguous zone").when(eez, "Exclusive economic zone").otherwise("Outside")


def overlapping_states(inside: DataFrame, layers: DataFrame) -> DataFrame:
    """Points in more than one state."""
    return inside.join(layers.where("layer = 'state'"), "pid").groupBy("qid").agg(F.count("*").alias("n")).where("n > 1")


def located(points: DataFrame, faces: DataFrame, cell_degrees: float = 0.02) -> DataFrame:
    """points (qid, lat, lon) with the face (corner columns lon_k, lat_k) that holds each, and barycentric weights w1..w3; of faces that share the place, the smallest."""
    c = lambda x: F.floor(x / cell_degrees).cast("long")
    x, y = [F.col(f"lon_{k}") for k in (1, 2, 3)], [F.col(f"lat_{k}") for k in (1, 2, 3)]
    f = faces.withColumn("cx", F.explode(F.sequence(c(F.least(*x)), c(F.greatest(*x))))).withColumn("cy", F.explode(F.sequence(c(F.least(*y)), c(F.greatest(*y)))))
    p = points.withColumn("cx", c(F.col("lon"))).withColumn("cy", c(F.col("lat")))
    inside, w = geo.in_triangle(F.col("lon"), F.col("lat"), *zip(x, y, strict=True))
    hit = p.join(f, ["cx", "cy"]).where(inside).withColumns({f"w{k + 1}": w[k] for k in range(3)})
    first = Window.partitionBy("qid").orderBy("face")
    return hit.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "cx", "cy")


def closed_lines(lines: DataFrame) -> DataFrame:
    """Boundary lines (pid, line array<struct<lon,lat>>) as (pid, crosses, ring): the padded band of latitudes for a line over the dateline, the convex hull of any other. Null and empty lines have a null ring."""
    rows = lines.select("pid", "line", dateline.crosses(F.col("line")).alias("crosses"))
    over = rows.where("crosses").select("pid", "crosses", dateline.band(F.col("line")).alias("ring"))
    rest = rows.where("not crosses")
    hull = convex_hull(rest.select("pid", F.explode("line").alias("p")).select("pid", "p.lon", "p.lat"), "pid")
    ring = hull.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("r"))
    ring = ring.select("pid", F.transform("r", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("ring"))
    return over.unionByName(rest.select("pid", "crosses").join(ring, "pid", "left"))


def repaired_boundaries(features: DataFrame, region: str) -> DataFrame:
    """features (pid, region, line, closed) with the lines of the regions whose name holds a word closed to polygons: closed says whether line is a ring afterwards. Rings, and lines of other regions, stay."""
    broken = ~F.coalesce(F.col("closed"), F.lit(False)) & F.coalesce(F.col("region").contains(region), F.lit(False))
    mended = closed_lines(features.where(broken).select("pid", "line")).select("pid", "ring")
    out = features.where(broken).drop("line", "closed").join(mended, "pid").withColumnRenamed("ring", "line").withColumn("closed", F.col("line").isNotNull())
    return features.where(~broken).unionByName(out)


def island_jurisdictions(points: DataFrame, boundaries: DataFrame, states: DataFrame, region: str, on_edge: Column | None = None) -> DataFrame:
    """points (qid, lat, lon) with the flags and names of the states (pid, ring, name) and of the boundaries (pid, region, line, closed, layer, name) that hold them; territorial seas and economic zones of the region are closed first. Keys of states and boundaries must differ. on_edge is as in containing; it may use more columns of the states, which are null for boundaries."""
    repair = F.col("layer").isin("ts", "eez")
    fixed = repaired_boundaries(boundaries.where(repair), region).unionByName(boundaries.where(~repair)).where("closed")
    rings = fixed.select("pid", F.col("line").alias("ring"), "layer", "name").unionByName(states.withColumn("layer", F.lit("state")), allowMissingColumns=True)
    return jurisdiction_flags(points, containing(points, rings.drop("layer", "name"), on_edge=on_edge), rings.select("pid", "layer", "name"))


def trimmed_at_shore(transect: DataFrame, key: str, times: float = 5.0) -> DataFrame:
    """Rows of each transect before its first step that is over the mean step by so many deviations."""
    w = Window.partitionBy(key).orderBy("along")
    whole = Window.partitionBy(key)
    rows = transect.withColumn("gap", F.col("along") - F.lag("along").over(w))
    rows = rows.withColumn("far", F.coalesce(F.col("gap") > F.avg("gap").over(whole) + times * F.stddev_pop("gap").over(whole), F.lit(False)).cast("int"))
    return rows.withColumn("_past", F.max("far").over(w)).where("_past = 0").drop("_past", "far")


def cell_edges(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Left and right edge of each position: midpoints to its neighbours, half a step beyond the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    x, before, after = F.col(order), F.lag(order).over(w), F.lead(order).over(w)
    return rows.withColumn("left_edge", F.coalesce((before + x) / 2, x - (after - x) / 2)).withColumn("right_edge", F.coalesce((x + after) / 2, x + (x - before) / 2))
