"""Series laid out for both ways of reading: by area and by face.

Faces are put in tiles along a space-filling curve, each of a bounded number of faces with a tight box, and a table's rows stand
by tile and, inside, in buckets by face in order of time. An area reads the tiles whose boxes it meets; a join or a sum by face of
tables with the same buckets needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tiles import BOX, curve, packed
from .scratch import kept

#: Faces of a tile, and buckets of a table; tables that are to be joined need as many.
FACES, BUCKETS = 4096, 32


def tiles_of_faces(faces: DataFrame, per_tile: int = FACES) -> tuple[DataFrame, DataFrame]:
    """(face, tile), and (tile, lat1, lat2, lon1, lon2, n), of faces (face, lat, lon)."""
    places = faces.select("face", "lat", "lon", *(F.col(c[:3]).alias(c) for c in BOX), curve(F.col("lat"), F.col("lon")).alias("_z"))
    found = packed(places, ["_z", "face"], leaf=per_tile)
    return found.items.select("face", F.col("node").alias("tile")), found.levels[0].select(F.col("node").alias("tile"), *BOX, "n")


def write_series(rows: DataFrame, tile_of: DataFrame, table: str, folder: str, buckets: int = BUCKETS) -> None:
    """rows (face, time, …) of the faces of tile_of (face, tile) as the table named, in folder. Each task writes a bucket: rows of one face, however many, are one sorted run."""
    out = rows.join(tile_of, "face").repartition(buckets, "face").sortWithinPartitions("tile", "face", "time")
    out.write.partitionBy("tile").bucketBy(buckets, "face").sortBy("face", "time").option("path", folder).mode("overwrite").saveAsTable(table)


def register(spark: SparkSession, schema: str, table: str, folder: str, buckets: int = BUCKETS) -> None:
    """Makes a table that another session wrote known to this one."""
    spark.sql(f"CREATE TABLE {table} ({schema}, tile BIGINT) USING parquet PARTITIONED BY (tile) CLUSTERED BY (face) SORTED BY (face, time) INTO {buckets} BUCKETS LOCATION '{folder}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")


def join_by_face(spark: SparkSession) -> None:
    """Lets joins of this session on face and time use the buckets by face, which are a part of their keys."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def read_area(spark: SparkSession, table: str, index: DataFrame, faces: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> DataFrame:
    """Rows of a table whose faces (face, lat, lon) lie in a rectangle. Only the folders of tiles that meet it are listed for the scan."""
    met = index.where((F.col("lat1") <= lat_max) & (F.col("lat2") >= lat_min) & (F.col("lon1") <= lon_max) & (F.col("lon2") >= lon_min))
    inside = kept(faces.where(F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max)).select("face", "lat", "lon"), "area")
    tiles = [r["tile"] for r in met.select("tile").orderBy("tile").collect()]  # as many as the area has faces by the thousand
    return spark.table(table).where(F.col("tile").isin(tiles) if tiles else F.lit(False)).join(inside, "face")
