"""Queries of ledgers, attributes, names, versions and classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, r6
from ..functions import geo, names
from ..operators import derive, records, summary
from .flow_queries import CORNERS

# Attributes of files: eleven keys, of which some files have another value or none.
ATTRS = "att AS (SELECT o_orderkey % 20 AS file, 'key' || CAST(o_orderkey // 20 % 11 AS VARCHAR) AS key, CAST(CASE WHEN o_orderkey // 20 % 11 IN (3, 5) AND o_orderkey % 20 = 7 THEN 'odd' ELSE 'same' END AS VARCHAR) AS value FROM orders WHERE NOT (o_orderkey // 20 % 11 = 8 AND o_orderkey % 20 = 2))"


def attributes(fx):
    k = F.col("o_orderkey")
    n, f = F.floor(k / 20) % 11, k % 20
    rows = fx.table("orders").where(~((n == 8) & (f == 2)))
    return rows.select(f.alias("file"), F.concat(F.lit("key"), n.cast("string")).alias("key"), F.when(n.isin(3, 5) & (f == 7), "odd").otherwise("same").alias("value"))


@query("flt_9_unequal_attributes", f"WITH {ATTRS} SELECT key, count(DISTINCT value) AS n_values, count(DISTINCT file) AS n_files FROM att WHERE key <> 'key5' GROUP BY key HAVING count(DISTINCT value) > 1 OR count(DISTINCT file) < 20")
def _(fx):
    return records.unequal_attributes(attributes(fx), ["key5"])


@query("flt_10_structure", f"WITH {ATTRS}, a AS (SELECT DISTINCT file, key AS component, value AS kind FROM att), r AS (SELECT DISTINCT component FROM a) SELECT f.file, r.component, 'same' AS expected, a.kind FROM (SELECT DISTINCT file FROM a) f CROSS JOIN r LEFT JOIN a ON a.file = f.file AND a.component = r.component WHERE a.kind IS NULL OR a.kind <> 'same'")
def _(fx):
    a = attributes(fx).select("file", F.col("key").alias("component"), F.col("value").alias("kind")).distinct()
    return records.structure_differences(a, a.select("component").distinct().withColumn("kind", F.lit("same")))


SPEC = "spec AS (SELECT p_partkey AS name, 'double' AS type, 'm' AS units FROM part WHERE p_partkey % 2 = 0), act AS (SELECT p_partkey AS name, CASE WHEN p_partkey % 14 = 0 THEN 'float' ELSE 'double' END AS type, CASE WHEN p_partkey % 22 = 0 THEN 'km' ELSE 'm' END AS units FROM part WHERE p_partkey % 10 <> 4)"


def specification(fx):
    """Variables declared and as they are."""
    k, part = F.col("p_partkey"), fx.table("part")
    declared = part.where(k % 2 == 0).select(k.alias("name"), F.lit("double").alias("type"), F.lit("m").alias("units"))
    return declared, part.where(k % 10 != 4).select(k.alias("name"), F.when(k % 14 == 0, "float").otherwise("double").alias("type"), F.when(k % 22 == 0, "km").otherwise("m").alias("units"))


@query("flt_11_specification", f"WITH {SPEC} SELECT s.name, CASE WHEN a.name IS NULL THEN 'missing' WHEN a.type <> s.type THEN 'type' ELSE 'units' END AS rule FROM spec s LEFT JOIN act a ON a.name = s.name WHERE a.name IS NULL OR a.type <> s.type OR a.units <> s.units")
def _(fx):
    return records.specification_violations(*specification(fx))


@query("flt_12_filled_attributes", "SELECT p_partkey AS name, 'units' AS key, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 = 0 THEN 'km' ELSE 'm' END AS value, p_partkey % 3 = 0 AND p_partkey % 6 = 0 AS conflict FROM part")
def _(fx):
    k = F.col("p_partkey")
    spec = fx.table("part").select(k.alias("name"), F.lit("units").alias("key"), F.lit("m").alias("value"))
    actual = fx.table("part").where(k % 3 == 0).select(k.alias("name"), F.lit("units").alias("key"), F.when(k % 6 == 0, "km").otherwise("m").alias("value"))
    return records.filled_attributes(spec, actual)


@query("flt_13_coordinate_range", f"SELECT face, {r6('lat * 15e-1')} AS lat FROM fx_points WHERE lat * 15e-1 > 895e-1")
def _(fx):
    return records.outside(fx.points.select("face", (F.col("lat") * 1.5).alias("lat")), "lat", -89.5, 89.5)


@query("flt_15_layers", f"WITH l AS (SELECT o_custkey AS node, o_orderkey % 10 AS sigma_layer, -(o_orderkey % 10 + 5e-1) / 10 + CASE WHEN o_orderkey % 10 = 6 THEN 1e-2 ELSE 0e0 END AS sigma FROM orders) SELECT sigma_layer, {r6('avg(sigma)')} AS mean, {r6('-(sigma_layer + 5e-1) / 10')} AS wanted FROM l GROUP BY sigma_layer HAVING var_pop(sigma) > 1e-6 OR abs(avg(sigma) + (sigma_layer + 5e-1) / 10) > 1e-6")
def _(fx):
    k = F.col("o_orderkey") % 10
    layers = fx.table("orders").select(F.col("o_custkey").alias("node"), k.alias("sigma_layer"), (-(k + 0.5) / 10 + F.when(k == 6, 0.01).otherwise(0.0)).alias("sigma"))
    return records.uneven_layers(layers).select("sigma_layer", "mean", "wanted")


@query("flt_16_null_counts", "SELECT 'b' AS column, count(*) FILTER (WHERE c_custkey % 5 = 0) AS n_null FROM customer UNION ALL SELECT 'c', count(*) FILTER (WHERE c_custkey % 9 = 1) FROM customer")
def _(fx):
    k = F.col("c_custkey")
    rows = fx.table("customer").select(k.alias("a"), F.when(k % 5 != 0, k).alias("b"), F.when(k % 9 != 1, k).alias("c"))
    return records.null_counts(rows, ["a", "b", "c"])


@query("flt_17_mismatched_coordinates", f"WITH a AS (SELECT face, lat FROM fx_points WHERE face % 17 <> 0), b AS (SELECT face, lat + CASE WHEN face % 13 = 0 THEN 1e-2 ELSE 0e0 END AS lat FROM fx_points WHERE face % 19 <> 0) SELECT coalesce(a.face, b.face) AS face, {r6('a.lat')} AS a, {r6('b.lat')} AS b FROM a FULL JOIN b ON a.face = b.face WHERE a.lat IS NULL OR b.lat IS NULL OR abs(a.lat - b.lat) > 1e-6 * abs(b.lat) + 1e-8")
def _(fx):
    f = F.col("face")
    a = fx.points.where(f % 17 != 0).select("face", "lat")
    b = fx.points.where(f % 19 != 0).select("face", (F.col("lat") + F.when(f % 13 == 0, 0.01).otherwise(0.0)).alias("lat"))
    return records.mismatched(a, b, "face", "lat", 1e-6)


CHANGES = "old AS (SELECT c_custkey AS k, CAST(c_custkey * 1e-1 AS VARCHAR) AS v FROM customer)"


@query("flt_25_unauthorised_changes", "SELECT 'k' || CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 4 = 1 AND c_custkey <> 5 AND c_custkey <> 9")
def _(fx):
    key = F.concat(F.lit("k"), F.col("c_custkey").cast("string"))
    old = fx.table("customer").select(key.alias("key"), F.col("c_custkey").cast("double").cast("string").alias("value"))
    moved = F.when(F.col("c_custkey") == 9, 5e-5).when(F.col("c_custkey") % 4 == 1, 1.0).otherwise(0.0)
    new = fx.table("customer").select(key.alias("key"), (F.col("c_custkey") + moved).cast("string").alias("value"))
    return records.unauthorised_changes(old, new, ["k5"], ["k9"]).select("key")


NAMED = "CASE WHEN face % 9 = 4 THEN 'draft-' || CAST(face AS VARCHAR) ELSE 'cook.tidal.face=' || CAST(face AS VARCHAR) || '.lat=' || printf('%.7f', lat) || '.lon=' || printf('%.7f', lon) || '-1h.parquet' END"


def point_names(fx):
    f = F.col("face")
    good = names.point_file(F.lit("cook"), F.lit("tidal"), f, F.col("lat"), F.col("lon"), F.lit("1h"))
    return fx.points.withColumn("name", F.when(f % 9 == 4, F.concat(F.lit("draft-"), f.cast("string"))).otherwise(good))


@query("scl_20_point_file_name", f"SELECT face, {NAMED} AS name FROM fx_points")
def _(fx):
    return point_names(fx).select("face", "name")


@query("flt_26_misnamed", f"SELECT {NAMED} AS name FROM fx_points WHERE face % 9 = 4")
def _(fx):
    return records.misnamed(point_names(fx)).select("name")


@query("scl_21_parse_point_file", f"SELECT face AS number, CASE WHEN face % 9 <> 4 THEN 'cook' END AS location, coalesce(CASE WHEN face % 9 <> 4 THEN face END, -1) AS face, CASE WHEN face % 9 <> 4 THEN {r6('lat')} END AS lat, CASE WHEN face % 9 <> 4 THEN '1h' END AS period FROM fx_points")
def _(fx):
    parts = names.parse_point_file(F.col("name"))
    parts["face"] = F.coalesce(parts["face"], F.lit(-1))
    return point_names(fx).select(F.col("face").alias("number"), *(parts[n].alias(n) for n in ("location", "face", "lat", "period")))


PATH = "'lat_deg=' || CAST(CAST(trunc(lat) AS INT) AS VARCHAR) || '/lon_deg=' || CAST(CAST(trunc(lon) AS INT) AS VARCHAR) || '/lat_dec=' || lpad(CAST(CAST(trunc(abs(lat * 100) % 100) AS INT) AS VARCHAR), 2, '0') || '/lon_dec=' || lpad(CAST(CAST(trunc(abs(lon * 100) % 100) AS INT) AS VARCHAR), 2, '0')"


@query("scl_19_partition_path", f"SELECT face, {PATH} AS path FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.partition_path(F.col("lat"), F.col("lon")).alias("path"))


@query("scl_22_parse_partition_path", "SELECT face, CAST(trunc(lat) AS INT) AS lat_deg, CAST(trunc(lon) AS INT) AS lon_deg, CAST(trunc(abs(lat * 100) % 100) AS INT) AS lat_dec FROM fx_points")
def _(fx):
    parts = names.parse_partition_path(geo.partition_path(F.col("lat"), F.col("lon")))
    return fx.points.select("face", *(parts[n].alias(n) for n in ("lat_deg", "lon_deg", "lat_dec")))


@query("scl_25_grid_id", "SELECT face, CAST(CAST(trunc(lat) AS INT) AS VARCHAR) || '_' || CAST(CAST(trunc(lon) AS INT) AS VARCHAR) || '_' || lpad(CAST(CAST(trunc(abs(lat * 100) % 100) AS INT) AS VARCHAR), 2, '0') || '_' || lpad(CAST(CAST(trunc(abs(lon * 100) % 100) AS INT) AS VARCHAR), 2, '0') AS grid_id FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.grid_id(F.col("lat"), F.col("lon")).alias("grid_id"))


PRODUCT = "lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '.' || lower(replace(n_name, ' ', '_')) || '.tidal.b1.v1.' || CAST(n_nationkey % 5 AS VARCHAR) || '.0.20050101.nc'"


def products(fx):
    n = F.col("n_nationkey")
    version = F.concat(F.lit("1."), (n % 5).cast("string"), F.lit(".0"))
    return fx.table("nation").select(n, names.product_file(n, F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))), F.lit("tidal"), F.lit("b1"), F.lit("20050101"), version).alias("name"))


@query("scl_24_product_file_name", f"SELECT n_nationkey, {PRODUCT} AS name FROM nation")
def _(fx):
    return products(fx)


@query("scl_23_parse_product_file", "SELECT CAST(n_nationkey AS INT) AS number, lower(replace(n_name, ' ', '_')) AS location, 'b1' AS level, '1.' || CAST(n_nationkey % 5 AS VARCHAR) || '.0' AS version, '20050101' AS date FROM nation")
def _(fx):
    parts = names.parse_product_file(F.col("name"))
    return products(fx).select(*(parts[n].alias(n) for n in ("number", "location", "level", "version", "date")))


VERSIONS = "ver AS (SELECT DISTINCT c_nationkey AS location, CAST(c_custkey % 3 AS VARCHAR) || '.' || CAST(c_custkey % 12 AS VARCHAR) || '.' || CAST(c_custkey % 2 AS VARCHAR) AS version FROM customer)"


def versions(fx):
    k = F.col("c_custkey")
    text = F.concat_ws(".", (k % 3).cast("string"), (k % 12).cast("string"), (k % 2).cast("string"))
    return fx.table("customer").select(F.col("c_nationkey").alias("location"), text.alias("version")).distinct()


@query("top_5_latest_version", f"WITH {VERSIONS}, p AS (SELECT *, CAST(split_part(version, '.', 1) AS INT) * 10000 + CAST(split_part(version, '.', 2) AS INT) * 100 + CAST(split_part(version, '.', 3) AS INT) AS o, count(*) OVER (PARTITION BY location) AS n FROM ver) SELECT location, version AS latest, n AS n_versions FROM p QUALIFY row_number() OVER (PARTITION BY location ORDER BY o DESC) = 1")
def _(fx):
    return records.latest_versions(versions(fx))


@query("jn_23_version_lookup", f"WITH {VERSIONS}, p AS (SELECT location, max(CAST(split_part(version, '.', 1) AS INT) * 10000 + CAST(split_part(version, '.', 2) AS INT) * 100 + CAST(split_part(version, '.', 3) AS INT)) AS o FROM ver GROUP BY location) SELECT n.n_name, CAST(o // 10000 AS VARCHAR) || '.' || CAST(o // 100 % 100 AS VARCHAR) || '.' || CAST(o % 100 AS VARCHAR) AS latest FROM p JOIN nation n ON n.n_nationkey = p.location")
def _(fx):
    nation = fx.table("nation").select(F.col("n_nationkey").alias("location"), "n_name")
    return records.latest_versions(versions(fx)).join(nation, "location").select("n_name", "latest")


@query("scl_27_next_patch", f"WITH {VERSIONS} SELECT location, version, split_part(version, '.', 1) || '.' || split_part(version, '.', 2) || '.' || CAST(CAST(split_part(version, '.', 3) AS INT) + 1 AS VARCHAR) AS next FROM ver")
def _(fx):
    return versions(fx).withColumn("next", names.next_patch(F.col("version")))


@query("jn_20_merged_versions", f"WITH {VERSIONS} SELECT location, version, CASE WHEN version LIKE '2.%' THEN 'old' ELSE 'new' END AS date FROM ver")
def _(fx):
    v = versions(fx)
    return records.merged_versions(v.withColumn("date", F.lit("old")), v.where("version not like '2.%'").withColumn("date", F.lit("new")))


@query("scl_28_face_batch", "SELECT c_custkey AS k, 'b' || CAST(c_nationkey AS VARCHAR) AS base, c_custkey * 10 AS start, c_custkey * 10 + 9 AS end FROM customer")
def _(fx):
    k = F.col("c_custkey")
    text = F.concat(F.lit("b"), F.col("c_nationkey").cast("string"), F.format_string(".faces=%08d-%08d.nc", k * 10, k * 10 + 9))
    parts = names.face_batch(F.col("name"))
    return fx.table("customer").select(k.alias("k"), text.alias("name")).select("k", *(parts[n].alias(n) for n in ("base", "start", "end")))


@query("scl_29_decode_time", "SELECT c_custkey AS k, TIMESTAMP '2005-01-01 00:00:00' + to_hours(CAST(c_custkey * 24 // CASE c_custkey % 2 WHEN 0 THEN 1 ELSE 24 END AS INT)) AS time FROM customer")
def _(fx):
    k = F.col("c_custkey")
    units = F.when(k % 2 == 0, "days since 2005-01-01 00:00:00").otherwise("hours since 2005-01-01 00:00:00")
    return fx.table("customer").select(k.alias("k"), names.decode_time(k, units).alias("time"))


@query("scl_30_history_date", "SELECT o_orderkey AS k, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d') || 'T02:03:04' AS date FROM orders")
def _(fx):
    d = F.to_date("o_orderdate")
    history = F.concat(F.lit("model run started at Sat "), F.date_format(d, "MMM"), F.lit(" "), F.lpad(F.dayofmonth(d).cast("string"), 2, " "), F.lit(" 02:03:04 "), F.year(d).cast("string"))
    return fx.table("orders").select(F.col("o_orderkey").alias("k"), names.history_date(history).alias("date"))


@query("jn_19_existing_files", "WITH r AS (SELECT DISTINCT 'f' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS name FROM orders WHERE o_orderkey % 4 = 0) SELECT file_index, 'skipped' AS upload_status FROM fx_ledger WHERE upload_status = 'pending' AND file_index % 4 = 0")
def _(fx):
    remote = fx.ledger.where("file_index % 4 = 0").select(F.concat(F.lit("bucket/"), F.col("s3_destination")).alias("path"))
    return records.existing_pending(fx.ledger, remote).select("file_index", "upload_status")


@query("set_5_failures", "SELECT file_index, '{\"file_index\":' || CAST(file_index AS VARCHAR) || ',\"file_size_bytes\":' || CAST(file_size_bytes AS VARCHAR) || '}' AS json FROM fx_ledger WHERE upload_status = 'failed'")
def _(fx):
    return fx.ledger.where("upload_status = 'failed'").select("file_index", F.to_json(F.struct("file_index", "file_size_bytes")).alias("json"))


@query("top_7_batch_of_pending", "WITH n AS (SELECT file_index, row_number() OVER (ORDER BY file_index) - 1 AS i FROM fx_ledger WHERE upload_status = 'pending') SELECT file_index FROM n WHERE i // 100 = 2")
def _(fx):
    return records.batch_of(fx.ledger.where("upload_status = 'pending'"), F.col("file_index"), 100, 2).select("file_index")


@query("snk_12_current_status", "WITH e AS (SELECT l_orderkey AS file_index, l_linenumber AS w, l_returnflag AS status FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY file_index ORDER BY w DESC, status DESC) AS rn FROM e) SELECT file_index, status, w AS \"at\" FROM r WHERE rn = 1")
def _(fx):
    events = fx.table("lineitem").select(F.col("l_orderkey").alias("file_index"), F.col("l_linenumber").alias("at"), F.col("l_returnflag").alias("status"))
    return records.current_status(events)


@query("flt_28_chunks", "SELECT k AS chunk, CASE WHEN k % 8 = 3 THEN 'missing' ELSE 'other variables' END AS problem FROM (SELECT DISTINCT o_custkey % 64 AS k FROM orders) s WHERE k % 8 = 3 OR k % 16 = 5")
def _(fx):
    k = fx.table("orders").select((F.col("o_custkey") % 64).alias("chunk")).distinct()
    held = F.when(F.col("chunk") % 16 == 5, F.array(F.lit("u"))).otherwise(F.array(F.lit("u"), F.lit("v")))
    return records.incomplete_chunks(k.where("chunk % 8 <> 3").select("chunk", F.explode(held).alias("variable")), k)


@query("set_3_array_differences", "SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 1 THEN 'node' ELSE '' END AS missing, CASE WHEN n_nationkey % 3 = 0 THEN 'nele' ELSE '' END AS extra FROM nation")
def _(fx):
    n = F.col("n_nationkey")
    actual = F.array_compact(F.array(F.lit("time"), F.when(n % 2 == 0, "node"), F.when(n % 3 == 0, "nele")))
    rows = fx.table("nation").select(n.alias("k"), F.array(F.lit("time"), F.lit("node")).alias("e"), actual.alias("a"))
    return records.array_differences(rows, "e", "a").select("k", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query("set_4_changed_not_allowed", "SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0")
def _(fx):
    c = fx.table("customer").select(F.col("c_custkey").alias("k"))
    return c.where("k % 3 = 0").join(c.where("k % 5 = 0"), "k", "left_anti")


@query("src_8_structure_report", "SELECT 'o_orderstatus' AS column, count(DISTINCT o_orderstatus) AS n_values, count(*) - count(o_orderstatus) AS n_null FROM orders UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), count(*) - count(o_custkey) FROM orders")
def _(fx):
    return records.schema_report(fx.table("orders").select("o_orderstatus", "o_custkey")).drop("type")


@query("scl_33_colour_class", "SELECT face, t, sigma_layer, CAST(least(greatest(floor(speed / (2e0 / 8)), 0), 7) AS INT) AS class FROM fx_layer")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", names.colour_class(F.col("speed"), 0.0, 2.0, 8).alias("class"))


@query("scl_34_discrete_class", "SELECT p_partkey AS k, CASE WHEN p_size * 20 <= 50 THEN 0 WHEN p_size * 20 <= 500 THEN 1 ELSE 2 END AS class FROM part")
def _(fx):
    return fx.table("part").select(F.col("p_partkey").alias("k"), names.range_class(F.col("p_size") * 20, [50.0, 500.0]).alias("class"))


@query("scl_41_range_label", "SELECT p_partkey AS k, CASE WHEN p_size >= 100 THEN printf('%.0f', CAST(p_size AS DOUBLE)) WHEN p_size >= 1 THEN printf('%.1f', CAST(p_size AS DOUBLE)) ELSE printf('%.2f', CAST(p_size AS DOUBLE)) END || '-' || printf('%.0f', p_size + 100e0) || ' m' AS label FROM part")
def _(fx):
    low = F.col("p_size").cast("double")
    return fx.table("part").select(F.col("p_partkey").alias("k"), names.range_label(low, low + 100.0, "m").alias("label"))


@query("scl_44_class_bounds", f"WITH m AS (SELECT DISTINCT CAST(p_size AS DOUBLE) AS x FROM part) SELECT {r6('x')} AS high, {r6('coalesce(lag(x) OVER (ORDER BY x), 0e0)')} AS low FROM m UNION ALL SELECT NULL, {r6('max(x)')} FROM m")
def _(fx):
    return records.discrete_bounds(fx.table("part").select(F.col("p_size").cast("double").alias("max")))


@query("scl_1_haversine", f"SELECT face, {r6('2 * 6371e0 * asin(sqrt(least(1e0, sin(radians(595e-1 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(595e-1)) * sin(radians(-1525e-1 - lon) / 2) ** 2)))')} AS km FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(59.5), F.lit(-152.5)).alias("km"))


_E2 = geo.FLATTENING * (2 - geo.FLATTENING)
_W = f"(1 - {_E2:.17e} * sin(radians((lat_1 + lat_2) / 2)) ** 2)"


@query("scl_2_ellipsoid_distance", f"WITH {CORNERS} SELECT face, (round(sqrt((radians(lat_2 - lat_1) * {geo.AXIS:.17e} * {1 - _E2:.17e} / ({_W} * sqrt({_W}))) ** 2 + (radians(lon_2 - lon_1) * {geo.AXIS:.17e} * cos(radians((lat_1 + lat_2) / 2)) / sqrt({_W})) ** 2), 3) + 0e0) AS metres FROM crn")
def _(fx):
    c = derive.with_corner_coordinates(fx.face, fx.node)
    return c.select("face", F.round(geo.ellipsoid_m(F.col("lat_1"), F.col("lon_1"), F.col("lat_2"), F.col("lon_2")), 3).alias("metres"))


@query("agg_20_grid_resolution", f"""WITH {CORNERS}, e AS (SELECT face, unnest([[lat_1, lon_1, lat_2, lon_2], [lat_2, lon_2, lat_3, lon_3], [lat_3, lon_3, lat_1, lon_1]]) AS s FROM crn),
    r AS (SELECT face, avg(2 * 6371000e0 * asin(sqrt(sin(radians(s[3] - s[1]) / 2) ** 2 + cos(radians(s[1])) * cos(radians(s[3])) * sin(radians(s[4] - s[2]) / 2) ** 2))) AS m FROM e GROUP BY face)
    SELECT (round(min(m), 3) + 0e0) AS min, (round(max(m), 3) + 0e0) AS max, (round(avg(m), 3) + 0e0) AS mean, (round(median(m), 3) + 0e0) AS median, (round(stddev_pop(m), 3) + 0e0) AS std,
    (round(quantile_cont(m, 5e-2), 3) + 0e0) AS p5, (round(quantile_cont(m, 25e-2), 3) + 0e0) AS p25, (round(quantile_cont(m, 75e-2), 3) + 0e0) AS p75, (round(quantile_cont(m, 95e-2), 3) + 0e0) AS p95 FROM r""")
def _(fx):
    c = derive.with_corner_coordinates(fx.face, fx.node)
    sides = [geo.haversine_km(F.col(f"lat_{a}"), F.col(f"lon_{a}"), F.col(f"lat_{b}"), F.col(f"lon_{b}")) * 1000 for a, b in ((1, 2), (2, 3), (3, 1))]
    m = c.select("face", ((sides[0] + sides[1] + sides[2]) / 3).alias("m"))
    found = summary.basic_statistics(m, "m", [], (0.05, 0.25, 0.5, 0.75, 0.95))
    return found.select(*(F.round(c, 3).alias(c) for c in found.columns))


@query("scl_3_wrapped_longitude", f"SELECT face, {r6('CASE WHEN (lon * 3 + 180) % 360 < 0 THEN (lon * 3 + 180) % 360 + 360 ELSE (lon * 3 + 180) % 360 END - 180')} AS lon FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.wrapped(F.col("lon") * 3).alias("lon"))


@query("scl_4_near_dateline", f"WITH l AS (SELECT face, -(120e0 + face % 60) AS a, 100e0 + face % 80 AS b FROM fx_points) SELECT face, {r6('CASE WHEN abs(a - b) <= 180 THEN a WHEN (a + b) / 2 >= 0 THEN CASE WHEN a < 0 THEN a + 360 ELSE a END ELSE CASE WHEN a > 0 THEN a - 360 ELSE a END END')} AS a, {r6('CASE WHEN abs(a - b) <= 180 THEN b WHEN (a + b) / 2 >= 0 THEN CASE WHEN b < 0 THEN b + 360 ELSE b END ELSE CASE WHEN b > 0 THEN b - 360 ELSE b END END')} AS b FROM l")
def _(fx):
    moved = geo.near_dateline(F.array(-(120.0 + F.col("face") % 60), 100.0 + F.col("face") % 80))
    return fx.points.select("face", moved.alias("m")).select("face", F.col("m")[0].alias("a"), F.col("m")[1].alias("b"))


@query("scl_5_westward", f"SELECT face, {r6('CASE WHEN -lon > 0 THEN -lon - 360 ELSE -lon END')} AS lon FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.westward(-F.col("lon")).alias("lon"))


@query("scl_9_crosses_dateline", "SELECT face, abs(lon - (lon + face % 300)) > 180 AS crosses FROM fx_points")
def _(fx):
    return fx.points.select("face", geo.crosses_dateline([F.col("lon"), F.col("lon") + F.col("face") % 300, F.col("lon")]).alias("crosses"))


@query("scl_7_utm_zone", "WITH p AS (SELECT face, lon + (face % 60) * 6 AS x, lat FROM fx_points) SELECT face, CAST(CASE WHEN lat >= 56 AND lat < 64 AND x >= 3 AND x < 12 THEN 32 ELSE CAST(floor((x + 180) / 6) AS BIGINT) % 60 + 1 END AS INT) AS zone FROM p")
def _(fx):
    return fx.points.select("face", geo.utm_zone(F.col("lon") + (F.col("face") % 60) * 6, F.col("lat")).alias("zone"))


@query("scl_14_triangle_wkt", f"WITH {CORNERS} SELECT face, 'POLYGON ((' || printf('%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f', lon_1, lat_1, lon_2, lat_2, lon_3, lat_3, lon_1, lat_1) || '))' AS wkt FROM crn")
def _(fx):
    c = derive.with_corner_coordinates(fx.face, fx.node)
    return c.select("face", geo.triangle_wkt([(F.col(f"lon_{k}"), F.col(f"lat_{k}")) for k in (1, 2, 3)]).alias("wkt"))


@query("scl_15_parse_polygon", f"WITH {CORNERS} SELECT face, {r6('lon_1')} AS first_lon, {r6('lat_2')} AS second_lat, 4 AS n FROM crn")
def _(fx):
    c = derive.with_corner_coordinates(fx.face, fx.node)
    ring = geo.parse_polygon(geo.triangle_wkt([(F.col(f"lon_{k}"), F.col(f"lat_{k}")) for k in (1, 2, 3)]))
    return c.select("face", ring.alias("r")).select("face", F.col("r")[0]["lon"].alias("first_lon"), F.col("r")[1]["lat"].alias("second_lat"), F.size("r").alias("n"))


@query("scl_39_destination", f"SELECT face, {r6('lat + 2e0 * cos(radians(face % 360)) / (pi() * 6371e0 / 180)')} AS lat2, {r6('lon + 2e0 * sin(radians(face % 360)) / (pi() * 6371e0 / 180 * cos(radians(lat)))')} AS lon2 FROM fx_points")
def _(fx):
    lat, lon = geo.destination(F.col("lat"), F.col("lon"), F.col("face") % 360, F.lit(2.0))
    return fx.points.select("face", lat.alias("lat2"), lon.alias("lon2"))
