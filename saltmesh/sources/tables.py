"""Reading and writing of tables, and inventories of their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, names
from ..operators.time_checks import InvalidData, assert_valid
from .scratch import exists, scratch

VELOCITY = "location string, t long, time timestamp_ntz, sigma_layer long, face long, u double, v double"


def read_declared(spark: SparkSession, paths: list[str], schema: str, exclude: str | None = None) -> DataFrame:
    """Parquet files with a declared schema, without those whose path matches exclude."""
    rows = spark.read.schema(schema).parquet(*paths)
    return rows if exclude is None else rows.where(~F.input_file_name().rlike(exclude))


def inventory(spark: SparkSession, folder: str, suffix: str = "*.parquet") -> DataFrame:
    """(path, relative_path, n_bytes, extension, modified) of the files below folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).load(folder)
    base = folder.rstrip("/").rsplit("/", 1)[1]
    relative = F.element_at(F.split("path", f"/{base}/"), -1)
    return files.select("path", relative.alias("relative_path"), F.col("length").alias("n_bytes"), names.extension(F.col("path")).alias("extension"), F.col("modificationTime").alias("modified"))


def numbered(rows: DataFrame, keys: list[str], index: str = "position") -> DataFrame:
    """rows with their place (from 0) in the order of keys. Each range of a range sort is counted by itself, so no task holds the list.
    The sorted ranges are written once: a range sort that ran again could draw other bounds."""
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, "numbered")
    ranged = rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    ranged.withColumn("_pos", F.row_number().over(Window.partitionBy("_part").orderBy(*keys))).write.parquet(folder)
    kept = spark.read.parquet(folder)
    sizes = kept.groupBy("_part").agg(F.count("*").alias("n"))
    before = sizes.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return kept.join(F.broadcast(before), "_part").withColumn(index, F.col("_before") + F.col("_pos") - 1).drop("_part", "_pos", "_before")


def ledger(files: DataFrame) -> DataFrame:
    """An inventory with a running index in order of paths, all pending."""
    rows = numbered(files.select("relative_path", "n_bytes"), ["relative_path"], "file_index")
    return rows.select("file_index", "relative_path", "n_bytes", F.lit("pending").alias("upload_status"))


#: What a precalculated table has to hold for each face.
PRECALCULATED = ("latitude_center", "longitude_center", "timezone_offset", "distance_to_shore", "jurisdiction", "mean_navd88_offset")


def precalculated_breaks(table: DataFrame, faces: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(face, problem) where a precalculated table and the centres of a mesh (face, lat, lon) don't agree: a face that one
    side alone has, or that is there twice, and coordinates further apart than the tolerance allows."""
    mine = table.groupBy("face").agg(F.count("*").alias("_n"), *(F.min(c).alias(c) for c in PRECALCULATED[:2]))
    both = mine.join(faces.select("face", "lat", "lon", F.lit(True).alias("_mesh")), "face", "full")
    off = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) > 1e-8 + tolerance * F.abs(F.col(b)), F.lit(True))
    problem = (
        F.when(F.col("_n").isNull(), "not precalculated").when(F.col("_mesh").isNull(), "not in the mesh").when(F.col("_n") > 1, "repeated")
        .when(off("lat", PRECALCULATED[0]), "latitude").when(off("lon", PRECALCULATED[1]), "longitude")
    )
    return both.select("face", problem.alias("problem")).where("problem is not null")


def read_precalculated(spark: SparkSession, path: str, faces: DataFrame) -> DataFrame:
    """A precalculated table that holds what it has to; raises if a column is missing or a face doesn't agree with the mesh."""
    table = spark.read.parquet(path)
    if missing := [c for c in ("face", *PRECALCULATED) if c not in table.columns]:
        raise InvalidData(f"columns missing: {', '.join(missing)}")
    assert_valid(precalculated_breaks(table, faces))
    return table


def append_missing(rows: DataFrame, folder: str, keys: list[str]) -> None:
    """Adds those partitions of rows (by keys) that the folder does not hold yet; to do it again adds nothing."""
    spark = rows.sparkSession
    if exists(spark, folder):
        rows = only_new(rows, spark.read.parquet(folder), keys)
    rows.repartition(*keys).sortWithinPartitions(*keys, "time").write.mode("append").partitionBy(*keys).parquet(folder)


def write_periods(rows: DataFrame, folder: str, period: Column, keys: list[str]) -> None:
    """One folder for each location and period, faces in order inside."""
    out = rows.withColumn("period", period)
    out.repartition(*keys, "period").sortWithinPartitions(*keys, "period", "face", "time").write.mode("overwrite").partitionBy(*keys, "period").parquet(folder)


PLACE = ("lat_deg", "lon_deg", "lat_dec", "lon_dec")


def write_point_series(rows: DataFrame, folder: str, parts: tuple[str, ...] = PLACE) -> None:
    """rows (face, lat, lon, time, …) by whole degrees and two decimals of their place, or some of these, each face in order of time. Places are dealt by face too, so that a full cell is not one task."""
    (a, b), (c, d) = geo.path_part(F.col("lat")), geo.path_part(F.col("lon"))
    out = rows.withColumns(dict(zip(PLACE, (a, c, b, d), strict=True)))
    out.repartition(*parts, F.pmod(F.xxhash64("face"), F.lit(8))).sortWithinPartitions(*parts, "face", "time").write.mode("overwrite").partitionBy(*parts).parquet(folder)


def only_new(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not there yet."""
    return rows.join(existing.select(*keys).distinct(), keys, "left_anti")


def with_attributes(df: DataFrame, attributes: dict[str, dict]) -> DataFrame:
    """Attributes of columns in the schema, which Parquet keeps."""
    for name, attrs in attributes.items():
        df = df.withMetadata(name, attrs)
    return df


def write_geojson(rows: DataFrame, folder: str, ring: str, properties: list[str]) -> None:
    """A polygon feature a line; ring is an array of (lon, lat)."""
    coordinates = F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(coordinates).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    rows.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(folder)


def write_grid_details(cells: DataFrame, folder: str) -> None:
    """One JSON object for each cell, by whole degrees."""
    out = cells.withColumns({"lat_deg": F.floor("centroid_lat"), "lon_deg": F.floor("centroid_lon")})
    out.select("lat_deg", "lon_deg", F.concat_ws("_", "cy", "cx").alias("grid_id"), "n_points", "points").repartition("lat_deg", "lon_deg").write.mode("overwrite").partitionBy("lat_deg", "lon_deg").json(folder)


def export_form(rows: DataFrame, values: list[str], layers: list[int], fill: float = -999.0) -> DataFrame:
    """rows (face, time, sigma_layer, values) with a column for each layer, missing values filled and times as text."""
    picks = [F.coalesce(F.max(F.when(F.col("sigma_layer") == k, F.col(v))), F.lit(fill)).alias(f"{v}_sigma_layer_{k:02d}") for v in values for k in layers]
    out = rows.groupBy("face", "time").agg(*picks)
    return out.withColumn("time_index", F.date_format("time", "yyyy-MM-dd HH:mm:ss'+00:00'")).drop("time")


def breaks_of_export(df: DataFrame) -> list[str]:
    """Columns that an export of two dimensions can't hold."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]


def attribute_versions(attributes: DataFrame, folder: str, version: int) -> None:
    """Appends (dataset, key, value) as a version."""
    attributes.withColumn("version", F.lit(version)).write.mode("append").parquet(folder)


def restored_attributes(versions: DataFrame, at_most: int) -> DataFrame:
    """Attributes as of a version: the latest value of each key up to it."""
    best = versions.where(F.col("version") <= at_most).groupBy("dataset", "key").agg(F.max_by("value", "version").alias("value"))
    return best
