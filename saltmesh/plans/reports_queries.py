"""Queries of sources and sinks (round trips), streaming, dateline shapes, transects and whole steps."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..catalog import query, r6
from ..functions import dateline, geo, names
from ..operators import derive, manifest, sites, spatial, summary
from ..sources import layout, tables
from ..streaming import running_summary
from . import steps
from .flow_queries import ATTRIBUTES, CORNERS, attributes, columns
from .lookups_queries import KM, SAMPLES, samples
from .records_queries import PATH, VERSIONS, versions
from .tides_queries import DIRECTED, LEVELS, MODES, PEAKS, PERIODS, PHASE


def located_faces(fx):
    return derive.with_corner_coordinates(fx.face, fx.node)


@query("snk_1_periods", f"SELECT t // 120 AS period, count(*) AS n, {r6('sum(u)')} AS total FROM fx_velocity GROUP BY 1")
def _(fx):
    """Written by site and period and read back."""
    folder = tables.scratch(fx.spark, "periods")
    tables.write_periods(fx.velocity.withColumn("location", F.lit("site")), folder, F.floor(F.col("t") / 120), ["location"])
    return fx.spark.read.parquet(folder).groupBy(F.col("period").cast("long").alias("period")).agg(F.count("*").alias("n"), F.sum("u").alias("total"))


@query("snk_2_point_layout", "SELECT CAST(trunc(lat) AS INT) AS lat_deg, CAST(trunc(abs(lat * 100) % 100) AS INT) AS lat_dec, count(*) AS n FROM fx_points GROUP BY 1, 2")
def _(fx):
    """By latitude alone here, which keeps the number of folders small."""
    folder = tables.scratch(fx.spark, "points")
    tables.write_point_series(fx.points.withColumn("time", F.lit("2005-01-01 00:00:00").cast("timestamp_ntz")), folder, ("lat_deg", "lat_dec"))
    return fx.spark.read.parquet(folder).groupBy("lat_deg", "lat_dec").agg(F.count("*").alias("n"))


def laid_out(fx, rows, tile_of, buckets=8):
    """A table of rows, under a name of its own."""
    folder = tables.scratch(fx.spark, "layout")
    name = f"layout_{folder.rsplit('-', 1)[1]}"
    layout.write_series(rows, tile_of, name, folder, buckets)
    return name


@query("snk_2_tiled_layout", f"""WITH {CORNERS}, pts AS (SELECT face, (lat_1 + lat_2 + lat_3) / 3 AS lat, (lon_1 + lon_2 + lon_3) / 3 AS lon FROM crn WHERE face IN (SELECT face FROM fx_velocity))
    SELECT v.face, v.t, v.sigma_layer, {r6('v.u')} AS u FROM fx_velocity v JOIN pts p ON p.face = v.face WHERE p.lat BETWEEN 5901e-2 AND 5903e-2 AND p.lon BETWEEN -15199e-2 AND -15197e-2""")
def _(fx):
    """The series of a rectangle, of which few tiles are read."""
    faces = series_points(fx).select("face", "lat", "lon")
    tile_of, index = layout.tiles_of_faces(faces, 8)
    name = laid_out(fx, fx.velocity, tile_of)
    return layout.read_area(fx.spark, name, index, faces, 59.01, 59.03, -151.99, -151.97).select("face", "t", "sigma_layer", "u")


@query("api_9_bucketed_series", f"SELECT v.face, count(*) AS n, {r6('avg(v.u * z.zeta_center)')} AS mean_product FROM fx_velocity v JOIN fx_zeta_center z ON z.face = v.face AND z.t = v.t GROUP BY v.face")
def _(fx):
    """Two tables by face, joined and summed without a shuffle."""
    layout.join_by_face(fx.spark)
    tile_of, _index = layout.tiles_of_faces(series_points(fx).select("face", "lat", "lon"), 8)
    flow, surface = (fx.spark.table(laid_out(fx, rows, tile_of)) for rows in (fx.velocity, derive.surface_at_faces(fx.zeta, fx.face)))
    return flow.join(surface.select("face", "t", "zeta_center").hint("shuffle_hash"), ["face", "t"]).groupBy("face").agg(F.count("*").alias("n"), F.avg(F.col("u") * F.col("zeta_center")).alias("mean_product"))


@query("snk_3_daily_partitions", f"SELECT strftime(time, '%Y-%m-%d') AS day, count(*) AS n, {r6('max(v)')} AS high FROM fx_velocity GROUP BY 1")
def _(fx):
    folder = tables.scratch(fx.spark, "daily")
    rows = fx.velocity.withColumn("day", F.date_format("time", "yyyy-MM-dd"))
    rows.repartition("day").sortWithinPartitions("day", "face").write.option("compression", "zstd").partitionBy("day").parquet(folder)
    back = fx.spark.read.schema("v double, day string").parquet(folder)
    return back.groupBy("day").agg(F.count("*").alias("n"), F.max("v").alias("high"))


@query("snk_4_only_new", "SELECT face, count(*) AS n FROM fx_velocity WHERE face % 4 <> 1 GROUP BY face")
def _(fx):
    existing = fx.velocity.where("face % 4 = 1").select("face")
    return tables.only_new(fx.velocity, existing, ["face"]).groupBy("face").agg(F.count("*").alias("n"))


@query("snk_5_schema_attributes", f"SELECT 'm s-1' AS units, {r6('max(u)')} AS high FROM fx_velocity")
def _(fx):
    folder = tables.scratch(fx.spark, "attributes")
    tables.with_attributes(fx.velocity.select("face", "u"), {"u": {"units": "m s-1"}}).write.parquet(folder)
    back = fx.spark.read.parquet(folder)
    return back.agg(F.lit(back.schema["u"].metadata["units"]).alias("units"), F.max("u").alias("high"))


@query("snk_6_geojson", f"WITH {CORNERS} SELECT face, {r6('lon_1')} AS lon, 4 AS n FROM crn")
def _(fx):
    folder = tables.scratch(fx.spark, "geojson")
    ring = F.array(*(F.struct(F.col(f"lon_{k}").alias("lon"), F.col(f"lat_{k}").alias("lat")) for k in (1, 2, 3)))
    tables.write_geojson(located_faces(fx).select("face", ring.alias("ring")), folder, "ring", ["face"])
    shape = "struct<type:string,geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<face:bigint>>"
    back = fx.spark.read.text(folder).select(F.from_json("value", shape).alias("f"))
    at = F.col("f.geometry.coordinates")[0]
    return back.select("f.properties.face", at[0][0].alias("lon"), F.size(at).alias("n"))


@query("snk_7_grid_details", "SELECT CAST(floor(lat * 100) AS BIGINT) AS cy, count(*) AS n FROM fx_points GROUP BY 1")
def _(fx):
    folder = tables.scratch(fx.spark, "grid")
    tables.write_grid_details(spatial.grid_index(fx.points), folder)
    back = fx.spark.read.schema("grid_id string, n_points long, points array<struct<face:long,lat:double,lon:double>>").json(folder)
    return back.groupBy(F.element_at(F.split("grid_id", "_"), 1).cast("long").alias("cy")).agg(F.sum(F.size("points")).alias("n"))


EXPORT = ", ".join(f"{r6(f'coalesce(max(CASE WHEN sigma_layer = {k} AND NOT (t % 13 = 5 AND sigma_layer = 2) THEN u END), -999e0)')} AS u_sigma_layer_0{k}" for k in range(4))


@query("snk_8_export_form", f"SELECT face, strftime(time, '%Y-%m-%d %H:%M:%S') || '+00:00' AS time_index, {EXPORT} FROM fx_velocity GROUP BY face, time")
def _(fx):
    out = tables.export_form(fx.velocity.where("not (t % 13 = 5 and sigma_layer = 2)"), ["u"], [0, 1, 2, 3])
    if tables.breaks_of_export(out):
        raise ValueError("an export has plain columns only")
    return out


@query("flt_36_export_contract", "SELECT count(DISTINCT face) AS n_faces, 0 AS n_breaks FROM fx_velocity")
def _(fx):
    out = tables.export_form(fx.velocity, ["u", "v"], [0, 1, 2, 3])
    return out.agg(F.count_distinct("face").alias("n_faces"), F.lit(len(tables.breaks_of_export(out))).alias("n_breaks"))


@query("snk_9_csv_round_trip", f"SELECT face, {r6('lat')} AS lat, {r6('lon')} AS lon FROM fx_points")
def _(fx):
    folder = tables.scratch(fx.spark, "csv")
    fx.points.write.option("header", True).csv(folder)
    return fx.spark.read.schema("face long, lat double, lon double").option("header", True).csv(folder)


@query("snk_11_restored_attributes", "SELECT c_nationkey AS dataset, 'k' || CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS value FROM customer")
def _(fx):
    folder = tables.scratch(fx.spark, "versions")
    rows = fx.table("customer").select(F.col("c_nationkey").alias("dataset"), F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("key"), "c_custkey")
    for version, part, value in ((1, rows, "first"), (2, rows.where("c_custkey % 2 = 0"), "second"), (3, rows, "third")):
        tables.attribute_versions(part.select("dataset", "key", F.lit(value).alias("value")), folder, version)
    return tables.restored_attributes(fx.spark.read.parquet(folder), 2)


@query("src_1_selected_files", f"SELECT face, {r6('sum(u)')} AS total FROM fx_velocity WHERE t // 120 <> 0 GROUP BY face")
def _(fx):
    """Files of the first period are left out by their path."""
    folder = tables.scratch(fx.spark, "selected")
    tables.write_periods(fx.velocity.withColumn("location", F.lit("site")), folder, F.floor(F.col("t") / 120), ["location"])
    rows = tables.read_declared(fx.spark, [folder], "face long, u double", exclude="period=0/")
    return rows.groupBy("face").agg(F.sum("u").alias("total"))


@query("src_9_inventory", "SELECT 'period=' || CAST(t // 120 AS VARCHAR) AS period, '.parquet' AS extension FROM fx_velocity GROUP BY 1")
def _(fx):
    folder = tables.scratch(fx.spark, "inventory")
    tables.write_periods(fx.velocity.withColumn("location", F.lit("site")), folder, F.floor(F.col("t") / 120), ["location"])
    files = tables.inventory(fx.spark, folder)
    return files.where("n_bytes > 0").select(F.regexp_extract("relative_path", r"(period=\d+)", 1).alias("period"), "extension").distinct()


@query("api_11_ledger", "WITH p AS (SELECT DISTINCT 'period=' || CAST(t // 120 AS VARCHAR) AS period FROM fx_velocity) SELECT CAST(row_number() OVER (ORDER BY period) - 1 AS BIGINT) AS file_index, period, '.parquet' AS extension, 'pending' AS upload_status, true AS filled FROM p")
def _(fx):
    """A row for each file of a layout by periods, in order of paths; a period of a site is one file."""
    folder = tables.scratch(fx.spark, "ledger")
    tables.write_periods(fx.velocity.withColumn("location", F.lit("site")), folder, F.floor(F.col("t") / 120), ["location"])
    rows = tables.ledger(tables.inventory(fx.spark, folder))
    return rows.select("file_index", F.regexp_extract("relative_path", r"(period=\d+)", 1).alias("period"), names.extension(F.col("relative_path")).alias("extension"), "upload_status", (F.col("n_bytes") > 0).alias("filled"))


@query("str_1_running_summary", f"SELECT face, count(*) AS n, {r6('avg(speed)')} AS mean, {r6('max(speed)')} AS high, {r6('min(speed)')} AS low, true AS p95_near FROM fx_layer GROUP BY face")
def _(fx):
    """Twelve files in three micro-batches; the sketch's percentile lies within three hundredths of the exact one."""
    source, state, check = (tables.scratch(fx.spark, n) for n in ("stream", "stream-state", "stream-checkpoint"))
    rows = derive.with_flow(fx.velocity).select("face", "t", "speed")
    rows.repartitionByRange(12, "t").write.parquet(source)
    found = running_summary.summary_of(running_summary.run(fx.spark, source, "face long, t long, speed double", state, check, "speed"))
    around = rows.groupBy("face").agg(F.percentile("speed", F.array(F.lit(0.92), F.lit(0.98))).alias("q"))
    return found.join(around, "face").select("face", "n", "mean", "high", "low", F.col("p95").between(F.col("q")[0], F.col("q")[1]).alias("p95_near"))


# Triangles along the equator of latitude 59, some of which lie over the dateline.
def dateline_faces(fx):
    base = F.pmod(F.col("face") * 0.7, F.lit(20.0)) + 170
    wrap = lambda x: F.when(x >= 180, x - 360).otherwise(x)
    points = [(base, F.lit(59.0)), (base + 1, F.lit(59.0)), (base + 0.5, F.lit(60.0))]
    return fx.points.select("face", F.array(*(F.struct(wrap(x).alias("lon"), y.alias("lat")) for x, y in points)).alias("ring"))


B = "(CAST(170 AS DOUBLE) + (face * 7 % 200) / 1e1)"


@query("scl_10_split_triangles", f"SELECT face, CASE WHEN {B} < 180 AND {B} + 1 > 180 THEN 2 ELSE 1 END AS n_parts FROM fx_points")
def _(fx):
    base = (F.col("face") * 7 % 200) / 10 + 170
    wrap = lambda x: F.when(x >= 180, x - 360).otherwise(x)
    points = [(base, F.lit(59.0)), (base + 1, F.lit(59.0)), (base + 0.5, F.lit(60.0))]
    rows = fx.points.select("face", F.array(*(F.struct(wrap(x).alias("lon"), y.alias("lat")) for x, y in points)).alias("ring"))
    return rows.select("face", F.size(dateline.split_at_dateline(F.col("ring"))).alias("n_parts"))


_CLIP = "CAST({a} AS INT) + CAST({b} AS INT) + CAST({c} AS INT) + CAST(({a}) <> ({b}) AS INT) + CAST(({b}) <> ({c}) AS INT) + CAST(({c}) <> ({a}) AS INT)"
_WEST, _EAST = (_CLIP.format(**dict(zip("abc", (f"{x} {side}" for x in ("x", "x + 1", "x + 5e-1")), strict=True))) for side in ("<= 1799995e-4", ">= 1800005e-4"))


@query("scl_11_split_rows", f"""WITH b AS (SELECT face, (face * 7e-1) % 20 + 170 AS x FROM fx_points), o AS (SELECT *, x + 1 > 180 AND x < 180 AS over, {_WEST} AS nw, {_EAST} AS ne FROM b)
    SELECT face, CAST(0 AS INT) AS split_part, CASE WHEN over THEN 2 ELSE 1 END AS split_total, CAST(CASE WHEN over THEN nw ELSE 3 END AS INT) AS n_points,
    {r6('CASE WHEN over THEN CASE WHEN nw > 0 THEN 1799995e-4 END ELSE greatest(CASE WHEN x >= 180 THEN x - 360 ELSE x END, CASE WHEN x + 1 >= 180 THEN x + 1 - 360 ELSE x + 1 END, CASE WHEN x + 5e-1 >= 180 THEN x + 5e-1 - 360 ELSE x + 5e-1 END) END')} AS lon_max FROM o
    UNION ALL SELECT face, 1, 2, CAST(ne AS INT), {r6('CASE WHEN ne > 0 THEN x + 1 - 360 END')} FROM o WHERE over""")
def _(fx):
    parts = dateline.split_at_dateline(F.col("ring"))
    return dateline_faces(fx).select("face", F.posexplode(parts).alias("split_part", "part"), F.size(parts).alias("split_total")).select("face", "split_part", "split_total", F.size("part").alias("n_points"), F.array_max(F.transform("part", lambda p: p["lon"])).alias("lon_max"))


def frame_sql(lat: str, lon: str, bearing: str) -> str:
    """The line's own frame: the way along it, and to its side, of each corner in km, and where its sides meet the line."""
    return f"""{CORNERS}, fr AS (SELECT face, {", ".join(f"(lon_{k} + {lon}) * (pi() * 6371e0 / 180 * cos(radians({lat}))) AS x{k}, (lat_{k} - {lat}) * (pi() * 6371e0 / 180) AS y{k}" for k in (1, 2, 3))} FROM crn),
    ln AS (SELECT face, {", ".join(f"x{k} * sin(radians({bearing})) + y{k} * cos(radians({bearing})) AS a{k}, x{k} * cos(radians({bearing})) - y{k} * sin(radians({bearing})) AS s{k}" for k in (1, 2, 3))} FROM fr),
    mt AS (SELECT face, {", ".join(f"CASE WHEN (s{a} > 0) <> (s{b} > 0) THEN a{a} + (a{b} - a{a}) * s{a} / (s{a} - s{b}) END AS m{k}" for k, (a, b) in enumerate(((1, 2), (2, 3), (3, 1))))} FROM ln),
    al AS (SELECT face, least(m0, m1, m2) AS i, greatest(m0, m1, m2) AS o, (least(m0, m1, m2) + greatest(m0, m1, m2)) / 2 AS along FROM mt)"""


@query("jn_15_transect", f"""WITH {frame_sql('59001e-3', '152e0', '60e0')}, ng AS (SELECT *, along - lag(along) OVER (ORDER BY along) AS gap FROM al WHERE along BETWEEN 0 AND 10), fa AS (SELECT *, coalesce(gap > avg(gap) OVER () + 5 * stddev_pop(gap) OVER (), false) AS far FROM ng),
    ps AS (SELECT *, bool_or(far) OVER (ORDER BY along) AS past FROM fa) SELECT face, {r6('i')} AS "into", {r6('o')} AS out_of, {r6('along')} AS along FROM ps WHERE NOT past""")
def _(fx):
    return steps.transect(located_faces(fx), 59.001, -152.0, 60.0, 10.0).select("face", "into", "out_of", "along")


WAYS = f"""{frame_sql('590233e-4', '151977e-3', '30e0')},
    ng AS (SELECT *, along >= 0 AS ahead, abs(along) - lag(abs(along)) OVER (PARTITION BY along >= 0 ORDER BY abs(along)) AS gap FROM al WHERE abs(along) <= 10),
    fa AS (SELECT *, coalesce(gap > avg(gap) OVER (PARTITION BY ahead) + 5 * stddev_pop(gap) OVER (PARTITION BY ahead), false) AS far FROM ng),
    ps AS (SELECT *, bool_or(far) OVER (PARTITION BY ahead ORDER BY abs(along)) AS past FROM fa),
    ed AS (SELECT face, i, o, along, lag(along) OVER (ORDER BY along) AS b, lead(along) OVER (ORDER BY along) AS a FROM ps WHERE NOT past)"""


@query("api_14_transect_both_ways", f"""WITH {WAYS}, l AS (SELECT face, sigma_layer, avg(speed) AS speed FROM fx_layer GROUP BY face, sigma_layer)
    SELECT ed.face, {r6('along')} AS along, {r6('i')} AS "into", {r6('o')} AS out_of, {r6('coalesce((b + along) / 2, along - (a - along) / 2)')} AS left_edge, {r6('coalesce((along + a) / 2, along + (along - b) / 2)')} AS right_edge, l.sigma_layer, {r6('l.speed')} AS speed FROM ed LEFT JOIN l ON l.face = ed.face""")
def _(fx):
    return steps.transect_both_ways(located_faces(fx), derive.with_flow(fx.velocity), 59.0233, -151.977, 30.0, 10.0).select("face", "along", "into", "out_of", "left_edge", "right_edge", "sigma_layer", "speed")


@query("win_7_trimmed_transect", "WITH s AS (SELECT s_suppkey // 20 AS line, (s_suppkey % 20) * 1e-1 + CASE WHEN s_suppkey % 20 >= 9 + s_suppkey // 20 % 7 THEN 50e0 ELSE 0e0 END AS along FROM supplier), g AS (SELECT *, along - lag(along) OVER (PARTITION BY line ORDER BY along) AS gap FROM s), f AS (SELECT *, coalesce(gap > avg(gap) OVER (PARTITION BY line) + 2 * stddev_pop(gap) OVER (PARTITION BY line), false) AS far FROM g), p AS (SELECT *, bool_or(far) OVER (PARTITION BY line ORDER BY along) AS past FROM f) SELECT line, count(*) AS n, (round(max(along), 6) + 0e0) AS last FROM p WHERE NOT past GROUP BY line")
def _(fx):
    """Lines of 20 suppliers each, with a jump after 9 to 15 of them."""
    k = F.col("s_suppkey")
    line, pos = F.floor(k / 20), k % 20
    rows = fx.table("supplier").select(line.alias("line"), (pos * 0.1 + F.when(pos >= 9 + line % 7, 50.0).otherwise(0.0)).alias("along"))
    return spatial.trimmed_at_shore(rows, "line", times=2.0).groupBy("line").agg(F.count("*").alias("n"), F.max("along").alias("last"))


@query("win_8_track_distance", f"WITH s AS (SELECT face % 20 AS track, face, lat - lag(lat) OVER (PARTITION BY face % 20 ORDER BY face) AS step FROM fx_points) SELECT track, face, {r6('sum(coalesce(abs(step), 0)) OVER (PARTITION BY track ORDER BY face)')} AS distance FROM s")
def _(fx):
    from pyspark.sql import Window

    w = Window.partitionBy("track").orderBy("face")
    rows = fx.points.withColumn("track", F.col("face") % 20).withColumn("step", F.coalesce(F.abs(F.col("lat") - F.lag("lat").over(w)), F.lit(0.0)))
    return rows.select("track", "face", F.sum("step").over(w).alias("distance"))


@query("win_12_cell_edges", f"WITH s AS (SELECT face % 20 AS track, lon, lag(lon) OVER w AS b, lead(lon) OVER w AS a FROM fx_points WINDOW w AS (PARTITION BY face % 20 ORDER BY lon)) SELECT track, {r6('lon')} AS lon, {r6('coalesce((b + lon) / 2, lon - (a - lon) / 2)')} AS left_edge, {r6('coalesce((lon + a) / 2, lon + (lon - b) / 2)')} AS right_edge FROM s")
def _(fx):
    return spatial.cell_edges(fx.points.select((F.col("face") % 20).alias("track"), "lon"), ["track"], "lon")


def utm_sql(x: str, y: str, zone: int) -> tuple[str, str]:
    """The same series in SQL, its coefficients as numbers."""
    n = geo.FLATTENING / (2 - geo.FLATTENING)
    a = geo.AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    beta, delta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480], [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    xi, eta = f"(({y}) / {a:.17e})", f"((({x}) - 500000e0) / {a:.17e})"
    xi1 = f"({xi} - " + " - ".join(f"{b:.17e} * sin({2 * k} * {xi}) * cosh({2 * k} * {eta})" for k, b in enumerate(beta, 1)) + ")"
    eta1 = f"({eta} - " + " - ".join(f"{b:.17e} * cos({2 * k} * {xi}) * sinh({2 * k} * {eta})" for k, b in enumerate(beta, 1)) + ")"
    chi = f"asin(sin({xi1}) / cosh({eta1}))"
    phi = f"({chi} + " + " + ".join(f"{d:.17e} * sin({2 * k} * {chi})" for k, d in enumerate(delta, 1)) + ")"
    return f"degrees(atan2(sinh({eta1}), cos({xi1}))) + {zone * 6 - 183}", f"degrees({phi})"


UTM_LON, UTM_LAT = utm_sql("400000e0 + face * 10", "6500000e0 + face * 7", 5)


@query("scl_6_utm_to_lonlat", f"SELECT face, {r6(UTM_LON)} AS lon, {r6(UTM_LAT)} AS lat FROM fx_points")
def _(fx):
    """The tests compare with known places too."""
    lon, lat = geo.utm_to_lonlat(F.lit(400000.0) + F.col("face") * 10, F.lit(6500000.0) + F.col("face") * 7, 5)
    return fx.points.select("face", lon.alias("lon"), lat.alias("lat"))


@query("set_2_all_locations", f"WITH a AS (SELECT 'first' AS location, face, avg(speed) AS m FROM fx_layer WHERE face < 25 GROUP BY face UNION ALL SELECT 'second', face - 25, avg(speed) FROM fx_layer WHERE face >= 25 GROUP BY face) SELECT location, face, {r6('m')} AS mean_speed FROM a")
def _(fx):
    means = derive.with_flow(fx.velocity).groupBy("face").agg(F.avg("speed").alias("mean_speed"))
    first = means.where("face < 25").withColumn("location", F.lit("first"))
    second = means.where("face >= 25").withColumn("face", F.col("face") - 25).withColumn("location", F.lit("second"))
    return first.unionByName(second, allowMissingColumns=True)


_PLACE = "printf('%.6f', {}) || ' ' || printf('%.6f', {})"


@query("agg_36_location_features", f"""WITH b AS (SELECT face % 6 AS k, count(*) AS n_points, min(lon) AS x1, max(lon) AS x2, min(lat) AS y1, max(lat) AS y2 FROM fx_points GROUP BY 1)
    SELECT 'site' || CAST(k AS VARCHAR) AS location, 'Site ' || CAST(k AS VARCHAR) AS label, n_points, 'POLYGON ((' || {' || chr(44) || chr(32) || '.join(_PLACE.format(*c) for c in (('x1', 'y1'), ('x2', 'y1'), ('x2', 'y2'), ('x1', 'y2'), ('x1', 'y1')))} || '))' AS wkt FROM b""")
def _(fx):
    k = (F.col("face") % 6).cast("string")
    points = fx.points.withColumn("location", F.concat(F.lit("site"), k))
    labels = points.select("location", F.concat(F.lit("Site "), k).alias("label")).distinct()
    return sites.location_features(points, labels).select("location", "label", "n_points", "wkt")


@query("scl_36_level_table", f"WITH m AS (SELECT max(speed) AS hi FROM fx_layer) SELECT CAST(k AS INT) AS level, {r6('hi * k / 8')} AS low, {r6('CASE WHEN k < 8 THEN hi * (k + 1) / 8 ELSE 1e9 END')} AS high FROM m CROSS JOIN (SELECT unnest(range(9)) AS k) s")
def _(fx):
    high = derive.with_flow(fx.velocity).agg(F.max("speed").alias("hi"))
    rows = high.select("hi", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("level"))
    return rows.select("level", (F.col("hi") * F.col("level") / 8).alias("low"), F.when(F.col("level") < 8, F.col("hi") * (F.col("level") + 1) / 8).otherwise(1e9).alias("high"))


@query("api_5_derived", f"""WITH c AS (SELECT face, t, avg(speed) AS m, quantile_cont(speed, 95e-2) AS q, max(512.5e0 * speed * speed * speed) AS p FROM fx_layer GROUP BY 1, 2), att AS ({ATTRIBUTES})
    SELECT face, sigma_layer, count(*) AS n, {r6('avg(speed)')} AS mean_speed, {r6('avg(d)')} AS mean_depth, {r6('avg(m)')} AS column_mean, {r6('max(q)')} AS column_p95, {r6('max(p)')} AS column_power, any_value(jurisdiction) AS jurisdiction
    FROM (SELECT l.face, l.sigma_layer, l.speed, -(f.h_center + z.zeta_center) * s.sigma AS d, c.m, c.q, c.p, a.jurisdiction FROM fx_layer l JOIN fx_zeta_center z ON z.face = l.face AND z.t = l.t JOIN fx_face f ON f.face = l.face JOIN fx_sigma s ON s.sigma_layer = l.sigma_layer JOIN c ON c.face = l.face AND c.t = l.t LEFT JOIN att a ON a.face = l.face) x GROUP BY 1, 2""")
def _(fx):
    rows = steps.derived(fx.velocity, columns(fx), fx.sigma, attributes(fx))
    return rows.groupBy("face", "sigma_layer").agg(
        F.count("*").alias("n"), F.avg("speed").alias("mean_speed"), F.avg("sigma_depth").alias("mean_depth"), F.avg("speed_mean").alias("column_mean"), F.max("speed_p95").alias("column_p95"),
        F.max("power_density_max").alias("column_power"), F.first("jurisdiction").alias("jurisdiction"),
    )


YEARLY = f"""{PEAKS}, {PHASE}, {DIRECTED}, {MODES}, flow AS (SELECT face, avg(speed) AS mean_speed, max(speed) AS max_speed, quantile_cont(speed, 95e-2) AS p95_speed, avg(5e-1 * 1025e0 * speed * speed * speed) AS mean_power FROM fx_layer GROUP BY face),
    two AS (SELECT face, max(CASE WHEN phase = 'flood' THEN bin * 2e0 END) AS flood_direction, max(CASE WHEN phase = 'ebb' THEN bin * 2e0 END) AS ebb_direction FROM modes WHERE rn = 1 AND sigma_layer = 0 GROUP BY face),
    rep AS (SELECT * EXCLUDE (n_periods, n_cycles) FROM (SELECT {LEVELS} FROM levels) JOIN (SELECT face, {PERIODS} FROM periods) USING (face))"""


@query("api_7_yearly", f"WITH {YEARLY} SELECT face, {', '.join(f'{r6(c)} AS {c}' for c in ('mean_speed', 'max_speed', 'p95_speed', 'mean_power', 'flood_direction', 'ebb_direction'))}, rep.* EXCLUDE (face) FROM flow LEFT JOIN two USING (face) LEFT JOIN rep USING (face)")
def _(fx):
    surface = derive.surface_at_faces(fx.zeta, fx.face).withColumn("zeta_center", F.round("zeta_center", 9))
    out = steps.yearly(derive.with_flow(fx.velocity), surface)
    return out.withColumn("mean_water", F.abs(F.round("mean_water", 6)))


STYLE = ["#111111", "#222222", "#333333", "#444444"]


@query("api_8_atlas", f"""WITH {CORNERS}, s AS (SELECT face, avg(speed) AS m, quantile_cont(speed, 95e-2) AS q FROM fx_layer GROUP BY face), l AS (SELECT face, {', '.join(f'avg(CASE WHEN sigma_layer = {k} THEN speed END) AS s{k}' for k in range(4))} FROM fx_layer GROUP BY face),
    w AS (SELECT 'site' || CAST(s.face % 3 AS VARCHAR) AS location, s.face, m, q, s0, s1, s2, s3, (lat_1 + lat_2 + lat_3) / 3 AS lat, (lon_1 + lon_2 + lon_3) / 3 AS lon, lon_3 FROM s JOIN l ON l.face = s.face JOIN crn ON crn.face = s.face)
    SELECT CAST(row_number() OVER (ORDER BY location, face) - 1 AS BIGINT) AS index, location, upper(location) AS label, lpad(CAST(face AS VARCHAR), 8, '0') AS face_id, location || '/' || {PATH} || '/' || location || '.tidal.face=' || CAST(face AS VARCHAR) || '.lat=' || printf('%.7f', lat) || '.lon=' || printf('%.7f', lon) || '-1h.parquet' AS path,
    {r6('m')} AS mean, {r6('q / m')} AS ratio, {', '.join(f'{r6(f"s{k}")} AS speed_sigma_level_{k}' for k in range(4))}, {STYLE}[1 + CAST(least(greatest(floor((m - 1) / 25e-2), 0), 3) AS INT)] AS fill_color_mean, {r6('lon_3')} AS lon_3 FROM w""")
def _(fx):
    """The tables of three sites, one after another, as the table of all."""
    flow = derive.with_flow(fx.velocity)
    place = lambda k: F.lit(f"site{k}")
    each = [steps.atlas(flow.where(F.col("face") % 3 == k), fx.face, fx.node, 4, {"mean": (1.0, 2.0, STYLE)}, place(k)) for k in range(3)]
    labels = fx.spark.createDataFrame([(f"site{k}", f"SITE{k}") for k in range(3)], "location string, label string")
    return steps.all_locations(each, labels).select("index", "location", "label", "face_id", "path", "mean", "ratio", *(f"speed_sigma_level_{k}" for k in range(4)), "fill_color_mean", "lon_3")


MANIFEST = f"""p AS (SELECT 'site' || CAST(face % 3 AS VARCHAR) AS location, * FROM fx_points),
    q AS (SELECT v.manifest_version, CAST(floor(lat * 100) AS BIGINT) AS cy, CAST(floor(lon * 100) AS BIGINT) AS cx, location, face, lat, lon FROM p JOIN (VALUES ('1.0.0'), ('1.0.1')) v(manifest_version) ON manifest_version = '1.0.1' OR NOT (face % 7 = 3 AND lat < 593e-1)),
    w AS (SELECT cy, cx, bool_or(face % 7 = 3 AND lat < 593e-1) AS changed FROM q GROUP BY 1, 2)"""


@query("api_10_manifest", f"""WITH {MANIFEST} SELECT q.manifest_version, q.cy, q.cx, CASE WHEN w.changed AND q.manifest_version = '1.0.1' THEN '1.0.1' ELSE '1.0.0' END AS written, CAST(count(*) OVER (PARTITION BY q.manifest_version, q.cy, q.cx) AS BIGINT) AS n_points, q.face,
    q.location || '/v2.1.0/' || {PATH} || '/' || q.location || '.tidal.face=' || CAST(q.face AS VARCHAR) || '.lat=' || printf('%.7f', q.lat) || '.lon=' || printf('%.7f', q.lon) || '-1h.parquet' AS path FROM q JOIN w ON w.cy = q.cy AND w.cx = q.cx""")
def _(fx):
    """Built before and after points were added in the south; both versions are read back, with the points and paths of every cell."""
    folder = tables.scratch(fx.spark, "manifest")
    points = fx.points.withColumn("location", F.concat(F.lit("site"), (F.col("face") % 3).cast("string")))
    out = None
    for rows in (points.where("not (face % 7 = 3 and lat < 59.3)"), points):
        version = manifest.build(rows, folder, "tidal", "1h", "2.1.0", "2025-06-01")
        cells = manifest.cells(fx.spark, folder, version).select("cy", "cx", "n_points")
        own = manifest.details(fx.spark, folder, version).join(cells, ["cy", "cx"]).select(F.lit(version).alias("manifest_version"), "cy", "cx", "written", "n_points", "face", "path")
        out = own if out is None else out.unionByName(own)
    return out


def series_points(fx):
    """Centres of the faces that have series; a strip is a location."""
    c = derive.with_corner_coordinates(fx.face, fx.node).join(fx.velocity.select("face").distinct(), "face")
    centre = lambda x: ((F.col(f"{x}_1") + F.col(f"{x}_2") + F.col(f"{x}_3")) / 3).alias(x)
    return c.select(F.concat(F.lit("site"), (F.floor(F.col("face") / 50) % 25).cast("string")).alias("location"), "face", centre("lat"), centre("lon"))


@query("api_19_point_lookup", f"""WITH {SAMPLES}, {CORNERS}, {VERSIONS}, pts AS (SELECT 'site' || CAST(face // 50 % 25 AS VARCHAR) AS location, face, (lat_1 + lat_2 + lat_3) / 3 AS lat, (lon_1 + lon_2 + lon_3) / 3 AS lon FROM crn WHERE face IN (SELECT face FROM fx_velocity)),
    near AS (SELECT q.qid, p.*, {KM} AS km FROM smp q CROSS JOIN pts p QUALIFY row_number() OVER (PARTITION BY q.qid ORDER BY {KM}, p.face) = 1),
    lat AS (SELECT 'site' || CAST(location AS VARCHAR) AS location, version, n_versions FROM (SELECT *, count(*) OVER (PARTITION BY location) AS n_versions FROM ver QUALIFY row_number() OVER (PARTITION BY location ORDER BY [CAST(x AS INT) FOR x IN string_split(version, '.')] DESC) = 1) x)
    SELECT n.qid, n.face, {r6('n.km')} AS km, l.version, l.n_versions, n.location || '/v' || l.version || '/' || {PATH} || '/' || n.location || '.tidal.face=' || CAST(n.face AS VARCHAR) || '.lat=' || printf('%.7f', n.lat) || '.lon=' || printf('%.7f', n.lon) || '-1h.parquet' AS path, v.t, v.sigma_layer, {r6('v.u')} AS u
    FROM near n JOIN lat l ON l.location = n.location LEFT JOIN fx_velocity v ON v.face = n.face WHERE n.km * 1000 <= 350""")
def _(fx):
    """Of every sample the series of the nearest point, from its location's latest version."""
    v = versions(fx).withColumn("location", F.concat(F.lit("site"), F.col("location").cast("string")))
    series = fx.velocity.select("face", "t", "sigma_layer", "u")
    return steps.lookup(samples(fx), series_points(fx), v, series, 350.0).select("qid", "face", "km", "version", "n_versions", "path", "t", "sigma_layer", "u")
