"""Profiles and cross-sections along lines, by linear interpolation between the centres of faces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .spatial import located


def dual_triangles(faces: DataFrame, nodes: DataFrame) -> DataFrame:
    """(face, c1, c2, c3, lon_k, lat_k) of faces (face, n1, n2, n3, lat, lon of the centre) and nodes (node, lon_node, lat_node): triangles between centres of faces.

    The centres about an inner node are a polygon, and these polygons fill the mesh up to its outermost centres. Each is cut into triangles
    from the centre of its smallest face. The column `face` numbers the triangles. A node is an inner one if its faces have as many other nodes as there are faces."""
    corners = ("n1", "n2", "n3")
    at = F.explode(F.array(*(F.struct(F.col(a).alias("node"), F.array(*(F.col(b) for b in corners if b != a)).alias("others")) for a in corners)))
    around = faces.select("face", "lat", "lon", at.alias("p")).select("face", "lat", "lon", "p.*").join(nodes, "node")
    angle = F.atan2(F.col("lat") - F.col("lat_node"), F.col("lon") - F.col("lon_node"))
    fans = around.groupBy("node").agg(F.array_sort(F.collect_list(F.struct(angle.alias("angle"), "face", "lat", "lon"))).alias("fan"), F.min("face").alias("low"), F.size(F.array_distinct(F.flatten(F.collect_list("others")))).alias("n_others"))
    fans = fans.where((F.size("fan") == F.col("n_others")) & (F.size("fan") >= 3))
    place = F.array_position(F.transform("fan", lambda f: f["face"]), F.col("low")).cast("int")
    turned = F.concat(F.slice("fan", place, F.size("fan")), F.slice("fan", F.lit(1), place - 1))
    out = fans.select("node", turned.alias("fan")).withColumn("k", F.explode(F.sequence(F.lit(2), F.size("fan") - 1)))
    own = [F.element_at("fan", k) for k in (F.lit(1), F.col("k"), F.col("k") + 1)]
    return out.select((F.col("node") * 1000 + F.col("k")).alias("face"), *(c["face"].alias(f"c{n}") for n, c in enumerate(own, 1)), *(c[x].alias(f"{x}_{n}") for x in ("lon", "lat") for n, c in enumerate(own, 1)))


def samples_of(lines: DataFrame, n: int) -> DataFrame:
    """(line, i, lat, lon, km) of lines (line, lat1, lon1, lat2, lon2): n places from start to end, with the way along the track."""
    part = F.col("i") / F.lit(float(n - 1))
    rows = lines.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    rows = rows.select("line", "i", (F.col("lat1") + part * (F.col("lat2") - F.col("lat1"))).alias("lat"), (F.col("lon1") + part * (F.col("lon2") - F.col("lon1"))).alias("lon"))
    w = Window.partitionBy("line").orderBy("i")
    step = geo.haversine_km(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    return rows.withColumn("_step", F.when(F.col("i") > 0, step).otherwise(0.0)).withColumn("km", F.sum("_step").over(w)).drop("_step")


def interpolated(samples: DataFrame, triangles: DataFrame, values: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """samples (line, i, and keys) with the columns of values (face, keys, columns), interpolated between the centres of the triangle about each; null outside the mesh, and where a centre has no value. One join and one sum for all columns."""
    places = samples.select("line", "i", "lat", "lon").distinct()
    found = located(places.select(F.struct("line", "i").alias("qid"), "lat", "lon"), triangles)
    corner = F.explode(F.array(*(F.struct(F.col(f"c{k}").alias("face"), F.col(f"w{k}").alias("w")) for k in (1, 2, 3))))
    corners = found.select("qid.line", "qid.i", corner.alias("p")).select("line", "i", "p.face", "p.w")
    wanted = samples.join(corners, ["line", "i"], "left").join(values, ["face", *keys], "left")
    whole = lambda c: F.when(F.count(F.col(c)) == 3, F.sum(F.col("w") * F.col(c))).alias(c)
    own = [c for c in samples.columns if c not in ("line", "i", *keys)]
    return wanted.groupBy("line", "i", *keys).agg(*(F.first(c).alias(c) for c in own), *map(whole, columns))


def profile(lines: DataFrame, n: int, triangles: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """(line, i, lat, lon, km, columns): the profile of each line in n samples."""
    return interpolated(samples_of(lines, n), triangles, values, [], columns)


def cross_section(lines: DataFrame, n: int, depth_levels: int, n_layers: int, triangles: DataFrame, depths: DataFrame, layers: DataFrame, depth: str, value: str) -> DataFrame:
    """(line, i, km, depth_level, level_depth, sigma_layer, depth, value): samples at levels from the surface down to the deepest sample of their line; each level takes the layer that lies as far down among the layers."""
    bottom = interpolated(samples_of(lines, n), triangles, depths, [], [depth])
    deepest = bottom.groupBy("line").agg(F.max(depth).alias("_deepest"))
    k: Column = F.col("depth_level")
    rows = bottom.join(deepest, "line").withColumn("depth_level", F.explode(F.sequence(F.lit(0), F.lit(depth_levels - 1))))
    rows = rows.withColumn("sigma_layer", F.least(F.floor(k * n_layers / depth_levels), F.lit(n_layers - 1)).cast("long")).withColumn("level_depth", F.col("_deepest") * k / (depth_levels - 1))
    # Several levels may share a layer: each layer of a sample is interpolated once.
    once = interpolated(rows.select("line", "i", "lat", "lon", "sigma_layer").distinct(), triangles, layers, ["sigma_layer"], [value])
    return rows.join(once.select("line", "i", "sigma_layer", value), ["line", "i", "sigma_layer"]).select("line", "i", "km", "depth_level", "level_depth", "sigma_layer", depth, value)
