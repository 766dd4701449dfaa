"""Sites, areas of interest, standard coordinates, time zones, storage paths and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, names


def standard_coordinates(nodes: DataFrame, zone: int) -> DataFrame:
    """nodes (node, lon, lat, x, y) with lon and lat from x and y where all given ones are zero; longitudes wrapped. One small aggregate decides for the table."""
    given = nodes.agg((F.max(F.abs("lon")) + F.max(F.abs("lat")) > 0).alias("given"))
    lon, lat = geo.utm_to_lonlat(F.col("x"), F.col("y"), zone)
    out = nodes.crossJoin(F.broadcast(given))
    return out.withColumns({"lon": geo.wrapped(F.when(F.col("given"), F.col("lon")).otherwise(lon)), "lat": F.when(F.col("given"), F.col("lat")).otherwise(lat)}).drop("given")


def areas_of_interest(spots: DataFrame, area_m2: float, prefix: str = "auto_") -> DataFrame:
    """spots (rank, lat, lon) as boxes of an area around them."""
    half = F.sqrt(F.lit(area_m2)) / 2 / 1000 / (F.lit(geo.RADIUS_KM) * 3.141592653589793 / 180)
    wide = half / F.cos(F.radians("lat"))
    return spots.select(F.concat(F.lit(prefix), F.col("rank").cast("string")).alias("name"), (F.col("lat") - half).alias("lat_min"), (F.col("lat") + half).alias("lat_max"), (F.col("lon") - wide).alias("lon_min"), (F.col("lon") + wide).alias("lon_max"))


def in_areas(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points of each area; areas mark the grid cells that they cover."""
    per = geo.PER_DEGREE
    span = lambda a, b: F.sequence(F.floor(F.col(a) * per).cast("long"), F.floor(F.col(b) * per).cast("long"))
    marked = areas.withColumn("cy", F.explode(span("lat_min", "lat_max"))).withColumn("cx", F.explode(span("lon_min", "lon_max")))
    at = points.withColumn("cy", geo.cell(F.col("lat"))).withColumn("cx", geo.cell(F.col("lon")))
    return at.join(marked, ["cy", "cx"]).where(F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lon").between(F.col("lon_min"), F.col("lon_max")))


def utc_offset_hours(zone: Column) -> Column:
    """Whole hours of a named time zone's standard time, cut toward zero."""
    noon = F.lit("2023-01-15 12:00:00").cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), zone, noon)
    return ((F.unix_seconds(local.cast("timestamp")) - F.unix_seconds(noon.cast("timestamp"))) / 3600).cast("int")


def island_jurisdiction(state: Column, ts: Column, eez: Column) -> Column:
    return F.when(state, "State waters").when(ts, "Territorial sea").when(eez, "Exclusive economic zone").otherwise("Outside")


def storage_paths(relative: Column, bucket: str, host: str, root: str) -> dict[str, Column]:
    return {"s3": F.concat(F.lit(f"s3://{bucket}/"), relative), "https": F.concat(F.lit(f"https://{host}/"), relative), "file": F.concat(F.lit(f"{root}/"), relative)}


def templated(template: str, **parts: Column) -> Column:
    """A path template with its {names} replaced."""
    out = F.lit(template)
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def lineage(files: DataFrame, level: str) -> DataFrame:
    """(location, json): the sorted inputs of a level for each location."""
    listed = F.array_sort(F.collect_list("path"))
    return files.groupBy("location").agg(F.to_json(F.create_map(F.lit(level), listed)).alias("json"))


def corrected_name(name: Column, first: Column) -> Column:
    """A product file's name with the date of its first time."""
    p = names.parse_product_file(name)
    return F.concat_ws(".", F.lpad(p["number"].cast("string"), 3, "0"), p["location"], p["dataset"], p["level"], F.concat(F.lit("v"), p["version"]), F.date_format(first, "yyyyMMdd"), p["ext"])


def fill_colours(df: DataFrame, styles: dict[str, tuple[float, float, list[str]]]) -> DataFrame:
    """A fill_color_ column for each styled variable (low, high, palette); black for null."""
    out = {}
    for name, (low, high, palette) in styles.items():
        k = names.colour_class(F.col(name), low, high, len(palette))
        out[f"fill_color_{name}"] = F.coalesce(F.element_at(F.array(*map(F.lit, palette)), k + 1), F.lit("#000000"))
    return df.withColumns(out)


def location_features(points: DataFrame, labels: DataFrame) -> DataFrame:
    """(location, label, n_points, lon_min, lon_max, lat_min, lat_max, wkt, feature) of points (location, lat, lon): the boundary of each location as a box, as text and as a GeoJSON feature. Partial sums come before the shuffle."""
    ends = [f(c).alias(f"{c}_{n}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max))]
    out = points.groupBy("location").agg(F.count("*").alias("n_points"), *ends).join(labels, "location", "left").withColumn("label", F.coalesce("label", "location"))
    ring = [("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"), ("lon_min", "lat_min")]
    text = F.concat_ws(", ", *(F.format_string("%.6f %.6f", F.col(x), F.col(y)) for x, y in ring))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*(F.array(x, y) for x, y in ring))).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct("location", "label", F.col("n_points").alias("point_count")).alias("properties"))
    return out.withColumns({"wkt": F.concat(F.lit("POLYGON (("), text, F.lit("))")), "feature": F.to_json(feature)})
