"""Variables derived row by row from velocity, surface and mesh tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import broadcast_if_few, kept

#: Water density in kg/m3, speed in m/s under which a direction is undefined, and Earth's radius in m.
RHO, STILL, EARTH_RADIUS = 1025.0, 0.01, 6371000.0
#: Numbers of nodes or faces, without other columns, that may be broadcast.
KEYS = 1_000_000


def no_nan(c: Column) -> Column:
    """NULL for NaN: aggregates then skip it."""
    return F.when(~F.isnan(c), c)


def speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def to_direction(u: Column, v: Column, still: float = STILL) -> Column:
    """Compass direction that the water moves to, NULL in still water."""
    return F.when(speed(u, v) > still, F.pmod(90 - F.degrees(F.atan2(v, u)), F.lit(360.0)))


def from_direction(to: Column) -> Column:
    return F.pmod(to + 180, F.lit(360.0))


def power_density(speed_: Column, rho: float = RHO) -> Column:
    return 0.5 * rho * speed_ * speed_ * speed_


def with_flow(velocity: DataFrame, rho: float = RHO, still: float = STILL) -> DataFrame:
    """velocity with speed, to_direction, from_direction and power_density."""
    out = velocity.withColumn("speed", speed(F.col("u"), F.col("v")))
    out = out.withColumn("to_direction", to_direction(F.col("u"), F.col("v"), still))
    return out.withColumn("from_direction", from_direction(F.col("to_direction"))).withColumn("power_density", power_density(F.col("speed"), rho))


def corners(faces: DataFrame) -> DataFrame:
    """(face, corner 1..3, node): one row per corner."""
    return faces.select("face", F.posexplode(F.array("n1", "n2", "n3")).alias("corner", "node")).withColumn("corner", F.col("corner") + 1)


def with_corner_coordinates(faces: DataFrame, nodes: DataFrame) -> DataFrame:
    """faces with lon_1..3 and lat_1..3: one join on the exploded corners, gathered per face."""
    at = corners(faces).join(nodes, "node")
    picks = [F.max(F.when(F.col("corner") == k, F.col(f"{c}_node"))).alias(f"{c}_{k}") for c in ("lon", "lat") for k in (1, 2, 3)]
    return faces.join(at.groupBy("face").agg(*picks), "face")


def faces_of_nodes(faces: DataFrame, rows: DataFrame) -> DataFrame:
    """faces that have a node among rows (node, …): a mesh may be much larger than the part that a series covers."""
    nodes = broadcast_if_few(kept(rows.select("node").distinct(), "nodes"), KEYS)
    ids = corners(faces).join(nodes, "node", "left_semi").select("face").distinct()
    return faces.join(broadcast_if_few(kept(ids, "ids"), KEYS), "face", "left_semi")


def surface_at_faces(zeta: DataFrame, faces: DataFrame) -> DataFrame:
    """(face, t, time, zeta_center): mean of the three nodes; the mesh is a dimension table."""
    return corners(faces).join(zeta, "node").groupBy("face", "t", "time").agg((F.sum("zeta") / 3).alias("zeta_center"))


def with_depths(surface: DataFrame, attributes: DataFrame) -> DataFrame:
    """surface (face, t, zeta_center) with surface_elevation and sea_floor_depth; attributes has face, h_center, mean_navd88_offset."""
    out = surface.join(attributes, "face")
    return out.withColumn("surface_elevation", F.col("zeta_center") - F.col("mean_navd88_offset")).withColumn("sea_floor_depth", F.col("h_center") + F.col("zeta_center"))


def with_sigma_depth(columns: DataFrame, sigma: DataFrame) -> DataFrame:
    """Depth of each layer below the surface; sigma has a row per layer."""
    return columns.crossJoin(F.broadcast(sigma)).withColumn("sigma_depth", -(F.col("sea_floor_depth")) * F.col("sigma"))


def chord(lon: Column, lat: Column) -> list[Column]:
    a, b = F.radians(lon), F.radians(lat)
    return [F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)]


def triangle_area(corner_columns: list[tuple[Column, Column]], radius: float = EARTH_RADIUS) -> Column:
    """Half the cross product of two edges between points on a sphere, in the square of radius."""
    p, q, r = (chord(lon, lat) for lon, lat in corner_columns)
    a, b = [y - x for x, y in zip(p, q, strict=True)], [y - x for x, y in zip(p, r, strict=True)]
    cross = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    return 0.5 * radius * radius * F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2])


def face_area(faces: DataFrame, nodes: DataFrame) -> DataFrame:
    at = with_corner_coordinates(faces, nodes)
    return at.withColumn("area", triangle_area([(F.col(f"lon_{k}"), F.col(f"lat_{k}")) for k in (1, 2, 3)]))


def element_volume(areas: DataFrame, columns: DataFrame, sigma: DataFrame) -> DataFrame:
    """area x water column x layer thickness for each face, time and layer."""
    layers = sigma.crossJoin(sigma.agg((F.lit(1.0) / F.count("*")).alias("thickness")))
    out = columns.join(areas.select("face", "area"), "face").crossJoin(F.broadcast(layers))
    return out.withColumn("volume", F.col("area") * F.col("sea_floor_depth") * F.col("thickness"))


def attach(rows: DataFrame, attributes: DataFrame, names: list[str]) -> DataFrame:
    """Per-face constants onto rows: a join on face with a dimension table."""
    return rows.join(attributes.select("face", *names), "face", "left")


def max_to_mean(p95: Column, mean: Column) -> Column:
    """The 95th percentile over the mean; NULL where the mean is 0."""
    return F.try_divide(p95, mean)


def layer_midpoints(levels: DataFrame) -> DataFrame:
    """levels (level, sigma_level) from the surface down, to (sigma_layer, sigma) midpoints."""
    from pyspark.sql import Window

    # The levels of one location are some ten rows.
    above = F.lag("sigma_level").over(Window.partitionBy("location").orderBy("level"))
    return levels.withColumn("sigma", (above + F.col("sigma_level")) / 2).where("sigma is not null").select("location", (F.col("level") - 1).alias("sigma_layer"), "sigma")


def renamed(df: DataFrame, vocabulary: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(vocabulary)


def standardised(df: DataFrame, spec: dict[str, tuple[str, dict]]) -> DataFrame:
    """Only the columns of spec {name: (type, attributes)}, cast, with attributes in the schema."""
    return df.select(*(F.col(n).cast(t).alias(n, metadata=a) for n, (t, a) in spec.items()))


def face_id(face: Column) -> Column:
    return F.lpad(face.cast("string"), 8, "0")


def hours(seconds: Column) -> Column:
    return seconds / 3600


def unit_label(name: Column) -> Column:
    """Unit by the name of a variable."""
    return (
        F.when(name.rlike("power_density"), "W/m2").when(name.rlike("direction"), "degrees").when(name.rlike("depth|elevation|zeta"), "m")
        .when(name.rlike("period"), "h").when(name.rlike("speed|^u$|^v$"), "m/s").otherwise("1")
    )


def sampled_vectors(flow: DataFrame, every: int, scale: Column, least: float, most: float) -> DataFrame:
    """Every n-th face with arrow components whose length is scale held between least and most."""
    size = F.least(F.greatest(scale, F.lit(least)), F.lit(most))
    out = flow.where(F.pmod(F.col("face"), F.lit(every)) == 0).withColumn("arrow", size)
    s = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))
    return out.withColumn("dx", F.when(s > 0, F.col("u") / s * F.col("arrow"))).withColumn("dy", F.when(s > 0, F.col("v") / s * F.col("arrow")))
