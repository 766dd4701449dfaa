"""A versioned manifest in two tiers: locations and cells in the first, the points of each cell with their paths in the second.

A folder holds tables, each by version. `build` compares the content of every cell with the version before and writes the
details of changed cells alone; cells that didn't change point to the details that an older version wrote. The version goes up
only if something changed, and counts once its row stands in `versions`, which is written last: a build that broke off leaves
nothing that a reader sees, and is done again under the same version. Every older version stays readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, names
from ..sources.scratch import exists, kept
from . import records
from .spatial import with_cell

FIRST_VERSION = "1.0.0"
#: Parts over which the points of a cell are dealt when they are written.
SLOTS = 8
TEMPLATE = "{location}/v{data_version}/lat_deg={lat_deg}/lon_deg={lon_deg}/lat_dec={lat_dec:02d}/lon_dec={lon_dec:02d}/{location}.{dataset}.face={face}.lat={lat:.7f}.lon={lon:.7f}-{period}.parquet"
CELLS = "cy long, cx long, centroid_lat double, centroid_lon double, n_points long, digest string, written string"
LOCATIONS = "location string, latest_version string, n_points long, lat_min double, lat_max double, lon_min double, lon_max double, period string"
HISTORY = "location string, version string, date string"
DETAILS = "cy long, cx long, location string, face long, lat double, lon double, path string"
VERSIONS = "parent string, n_cells long, n_changed long, n_removed long, path_template string"


def point_paths(points: DataFrame, dataset: str, period: str, data_version: str) -> DataFrame:
    """points (location, face, lat, lon) with their cell and the path of their series."""
    file = names.point_file(F.col("location"), F.lit(dataset), F.col("face"), F.col("lat"), F.col("lon"), F.lit(period))
    path = F.concat_ws("/", "location", F.lit(f"v{data_version}"), geo.partition_path(F.col("lat"), F.col("lon")), file)
    return with_cell(points.select("location", "face", "lat", "lon")).withColumn("path", path)


def cell_digests(rows: DataFrame) -> DataFrame:
    """(cy, cx, n_points, digest) of rows of `point_paths`. The digest doesn't depend on the order of points, and has partial sums before the shuffle: no task lists a cell."""
    content = [F.xxhash64("location", "face", "lat", "lon", "path"), F.xxhash64("path", "lon", "lat", "face", "location")]
    out = rows.groupBy("cy", "cx").agg(F.count("*").alias("n_points"), F.sum(content[0].cast("decimal(38,0)")).alias("_a"), F.bit_xor(content[1]).alias("_b"))
    return out.select("cy", "cx", "n_points", F.concat_ws(":", "n_points", "_a", "_b").alias("digest"))


def committed(spark: SparkSession, folder: str) -> DataFrame | None:
    """The versions that count, with what they changed; None before the first."""
    return spark.read.parquet(f"{folder}/versions") if exists(spark, f"{folder}/versions") else None


def latest(spark: SparkSession, folder: str) -> str | None:
    versions = committed(spark, folder)
    found = versions and versions.agg(F.max(F.struct(names.semver(F.col("manifest_version")).alias("v"), "manifest_version")).alias("b")).select("b.manifest_version").collect()
    return found[0][0] if found else None


def _table(spark: SparkSession, folder: str, what: str, schema: str, version: str | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{what}/manifest_version={version}")


def cells(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """Cells of a version, the latest if none is named."""
    return _table(spark, folder, "cells", CELLS, version or latest(spark, folder))


def locations(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    return _table(spark, folder, "locations", LOCATIONS, version or latest(spark, folder))


def history(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """(location, version, date): all data versions that a manifest version knows."""
    return _table(spark, folder, "history", HISTORY, version or latest(spark, folder))


def details(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """Points with their paths as of a version: of each cell, those that the version named in the cell wrote."""
    own = cells(spark, folder, version).select("cy", "cx", "written")
    rows = spark.read.schema(f"{DETAILS}, written string, lat_deg int, lon_deg int").json(f"{folder}/grids")
    return rows.join(own, ["cy", "cx", "written"]).drop("lat_deg", "lon_deg")


def build(points: DataFrame, folder: str, dataset: str, period: str, data_version: str, date: str) -> str:
    """Brings the manifest in folder up to points (location, face, lat, lon) of a data version; returns the version that holds then, the one before if nothing changed."""
    spark = points.sparkSession
    old = latest(spark, folder)
    major, minor, patch = map(int, old.split(".")) if old else (0, 0, 0)
    new = f"{major}.{minor}.{patch + 1}" if old else FIRST_VERSION

    rows = point_paths(points, dataset, period, data_version)
    before = cells(spark, folder, old) if old else spark.createDataFrame([], CELLS)
    both = cell_digests(rows).join(before.select("cy", "cx", F.col("digest").alias("_digest"), F.col("written").alias("_written")), ["cy", "cx"], "full")
    same = F.col("digest").eqNullSafe(F.col("_digest"))
    both = kept(both.withColumn("written", F.when(same, F.col("_written")).otherwise(F.lit(new))), "manifest")
    known = both.where("digest is not null")
    n = both.agg(F.count("digest").alias("cells"), F.count(F.when(~same & F.col("digest").isNotNull(), 1)).alias("changed"), F.count(F.when(F.col("digest").isNull(), 1)).alias("removed")).collect()[0]

    box = [f(c).alias(f"{c}_{m}") for c in ("lat", "lon") for m, f in (("min", F.min), ("max", F.max))]
    places = points.groupBy("location").agg(F.count("*").alias("n_points"), *box).select("location", F.lit(data_version).alias("latest_version"), "n_points", "lat_min", "lat_max", "lon_min", "lon_max", F.lit(period).alias("period"))
    released = places.select("location", F.lit(data_version).alias("version"), F.lit(date).alias("date"))
    past = history(spark, folder, old) if old else spark.createDataFrame([], HISTORY)
    dates = kept(records.merged_versions(past, released), "history")
    if old and not n["changed"] and not n["removed"] and dates.exceptAll(past).isEmpty():
        return old

    changed = known.where(F.col("written") == new).select("cy", "cx")
    out = rows.join(changed, ["cy", "cx"], "left_semi").withColumns({"lat_deg": F.floor("lat").cast("int"), "lon_deg": F.floor("lon").cast("int"), "_slot": F.pmod(F.xxhash64("face"), F.lit(SLOTS))})
    out = out.repartition("cy", "cx", "_slot").sortWithinPartitions("cy", "cx", "face").drop("_slot")
    out.select("cy", "cx", "location", "face", "lat", "lon", "path", "lat_deg", "lon_deg").write.mode("overwrite").partitionBy("lat_deg", "lon_deg").json(f"{folder}/grids/written={new}")
    centre = lambda c: (F.col(c) + 0.5) / geo.PER_DEGREE
    first = known.select("cy", "cx", centre("cy").alias("centroid_lat"), centre("cx").alias("centroid_lon"), "n_points", "digest", "written")
    row = spark.createDataFrame([(old, n["cells"], n["changed"], n["removed"], TEMPLATE)], VERSIONS)
    for what, table in (("cells", first), ("locations", places), ("history", dates), ("versions", row)):
        table.write.mode("overwrite").parquet(f"{folder}/{what}/manifest_version={new}")
    return new
