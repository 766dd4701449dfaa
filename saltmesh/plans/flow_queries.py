"""Queries of row-wise variables and of the mesh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import query, r6
from ..fixtures import Fixtures
from ..operators import derive, summary

KEY = "face, t, sigma_layer"
DIRECTION = "CASE WHEN sqrt(u*u+v*v) > 1e-2 THEN CASE WHEN 90 - degrees(atan2(v,u)) < 0 THEN 90 - degrees(atan2(v,u)) + 360 ELSE 90 - degrees(atan2(v,u)) END END"
# Constants per face that stand for the precalculated attributes.
ATTRIBUTES = "SELECT face, h_center, CAST(-9 + face % 3 AS INT) AS timezone_offset, face * 1e-1 AS distance_to_shore, CASE face % 3 WHEN 0 THEN 'State' WHEN 1 THEN 'Federal' ELSE 'None' END AS jurisdiction, face * 2e-1 + 1e2 AS grid_resolution FROM fx_face"


def attributes(fx: Fixtures) -> DataFrame:
    f = F.col("face")
    kind = F.when(f % 3 == 0, "State").when(f % 3 == 1, "Federal").otherwise("None")
    return fx.face.select("face", "h_center", (f % 3 - 9).cast("int").alias("timezone_offset"), (f * 1e-1).alias("distance_to_shore"), kind.alias("jurisdiction"), (f * 2e-1 + 1e2).alias("grid_resolution"))


def columns(fx: Fixtures) -> DataFrame:
    """(face, t, zeta_center, sea_floor_depth, surface_elevation) with the mean of each face as its offset."""
    surface = derive.surface_at_faces(fx.zeta, fx.face)
    offset = surface.groupBy("face").agg(F.avg("zeta_center").alias("mean_navd88_offset"))
    return derive.with_depths(surface, fx.face.join(offset, "face"))


COLUMNS = """cols AS (SELECT z.face, z.t, z.zeta_center, f.h_center + z.zeta_center AS sea_floor_depth, z.zeta_center - avg(z.zeta_center) OVER (PARTITION BY z.face) AS surface_elevation
    FROM fx_zeta_center z JOIN fx_face f ON f.face = z.face)"""


@query("prj_1_speed", f"SELECT {KEY}, {r6('sqrt(u*u+v*v)')} AS speed FROM fx_velocity")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", "speed")


@query("prj_2_to_direction", f"SELECT {KEY}, {r6(DIRECTION)} AS to_direction FROM fx_velocity")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", "to_direction")


@query("prj_3_from_direction", f"SELECT {KEY}, {r6('(' + DIRECTION + ' + 180) % 360')} AS from_direction FROM fx_velocity")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", "from_direction")


@query("prj_4_power_density", f"SELECT {KEY}, {r6('5e-1 * 1025e0 * sqrt(u*u+v*v) * sqrt(u*u+v*v) * sqrt(u*u+v*v)')} AS power_density FROM fx_velocity")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", "power_density")


@query("prj_5_depths", f"WITH {COLUMNS} SELECT face, t, {r6('sea_floor_depth')} AS sea_floor_depth, {r6('surface_elevation')} AS surface_elevation FROM cols")
def _(fx):
    return columns(fx).select("face", "t", "sea_floor_depth", "surface_elevation")


@query("prj_6_sigma_depth", f"WITH {COLUMNS} SELECT face, t, sigma_layer, {r6('-sea_floor_depth * sigma')} AS sigma_depth FROM cols CROSS JOIN fx_sigma")
def _(fx):
    return derive.with_sigma_depth(columns(fx), fx.sigma).select("face", "t", "sigma_layer", "sigma_depth")


@query("prj_7_sea_floor_depth", f"WITH {COLUMNS} SELECT face, max(t) AS t_last, {r6('max(sea_floor_depth)')} AS deepest FROM cols GROUP BY face")
def _(fx):
    return columns(fx).groupBy("face").agg(F.max("t").alias("t_last"), F.max("sea_floor_depth").alias("deepest"))


CORNERS = """crn AS (SELECT f.face, f.n1, f.n2, f.n3, f.h_center, a.lon_node AS lon_1, a.lat_node AS lat_1, b.lon_node AS lon_2, b.lat_node AS lat_2, c.lon_node AS lon_3, c.lat_node AS lat_3
    FROM fx_face f JOIN fx_node a ON a.node = f.n1 JOIN fx_node b ON b.node = f.n2 JOIN fx_node c ON c.node = f.n3)"""
XYZ = ", ".join(f"cos(radians(lat_{k}))*cos(radians(lon_{k})) AS x{k}, cos(radians(lat_{k}))*sin(radians(lon_{k})) AS y{k}, sin(radians(lat_{k})) AS z{k}" for k in (1, 2, 3))
AREA = f"""{CORNERS}, xyz AS (SELECT face, {XYZ} FROM crn),
    edg AS (SELECT face, x2-x1 AS ax, y2-y1 AS ay, z2-z1 AS az, x3-x1 AS bx, y3-y1 AS by_, z3-z1 AS bz FROM xyz),
    areas AS (SELECT face, 5e-1 * 6371000e0 * 6371000e0 * sqrt((ay*bz-az*by_)*(ay*bz-az*by_) + (az*bx-ax*bz)*(az*bx-ax*bz) + (ax*by_-ay*bx)*(ax*by_-ay*bx)) AS area FROM edg)"""


@query("prj_8_face_area", f"WITH {AREA} SELECT face, (round(area, 3) + 0e0) AS area FROM areas")
def _(fx):
    return derive.face_area(fx.face, fx.node).select("face", F.round("area", 3).alias("area"))


@query("prj_9_element_volume", f"WITH {AREA}, {COLUMNS} SELECT c.face, s.sigma_layer, (round(avg(a.area * c.sea_floor_depth / 4e0), 2) + 0e0) AS volume FROM cols c JOIN areas a ON a.face = c.face CROSS JOIN fx_sigma s GROUP BY c.face, s.sigma_layer")
def _(fx):
    rows = derive.element_volume(derive.face_area(fx.face, fx.node), columns(fx), fx.sigma)
    return rows.groupBy("face", "sigma_layer").agg(F.round(F.avg("volume"), 2).alias("volume"))


def _attached(name: str, column: str, shown: str) -> None:
    @query(name, f"WITH att AS ({ATTRIBUTES}) SELECT v.face, v.t, v.sigma_layer, {shown.replace('c.', 'a.')} AS {column} FROM fx_velocity v JOIN att a ON a.face = v.face")
    def _(fx):
        return derive.attach(fx.velocity, attributes(fx), [column]).select("face", "t", "sigma_layer", column)


_attached("prj_10_timezone_offset", "timezone_offset", "c.timezone_offset")
_attached("prj_11_distance_to_shore", "distance_to_shore", r6("c.distance_to_shore"))
_attached("prj_12_jurisdiction", "jurisdiction", "c.jurisdiction")
_attached("prj_13_grid_resolution", "grid_resolution", r6("c.grid_resolution"))


@query("jn_3_face_attributes", f"WITH att AS ({ATTRIBUTES}) SELECT a.jurisdiction, a.timezone_offset, count(*) AS n, {r6('avg(l.speed)')} AS mean_speed FROM fx_layer l JOIN att a ON a.face = l.face GROUP BY 1, 2")
def _(fx):
    rows = derive.attach(derive.with_flow(fx.velocity), attributes(fx), ["jurisdiction", "timezone_offset"])
    return rows.groupBy("jurisdiction", "timezone_offset").agg(F.count("*").alias("n"), F.avg("speed").alias("mean_speed"))


@query("prj_14_max_to_mean", f"SELECT face, sigma_layer, {r6('quantile_cont(speed, 95e-2) / nullif(avg(speed), 0)')} AS ratio FROM fx_layer GROUP BY 1, 2")
def _(fx):
    rows = summary.summary(derive.with_flow(fx.velocity), "speed", ["face", "sigma_layer"])
    return rows.select("face", "sigma_layer", derive.max_to_mean(F.col("p95"), F.col("mean")).alias("ratio"))


@query("prj_15_standard_names", "SELECT face AS nele, t AS step, u AS x_sea_water_velocity, v AS y_sea_water_velocity, sigma_layer AS siglay FROM fx_velocity")
def _(fx):
    names = {"face": "nele", "t": "step", "u": "x_sea_water_velocity", "v": "y_sea_water_velocity", "sigma_layer": "siglay"}
    return derive.renamed(fx.velocity.drop("time"), names)


@query("prj_16_declared_types", f"SELECT CAST(face AS INT) AS face, CAST(t AS INT) AS t, CAST(sigma_layer AS INT) AS sigma_layer, {r6('CAST(u AS DOUBLE)')} AS u FROM fx_velocity")
def _(fx):
    spec = {"face": ("int", {"long_name": "cell"}), "t": ("int", {}), "sigma_layer": ("int", {}), "u": ("double", {"units": "m s-1"})}
    return derive.standardised(fx.velocity, spec)


@query("prj_17_declared_columns", "SELECT face, t, sigma_layer, v FROM fx_velocity")
def _(fx):
    return derive.standardised(fx.velocity, {n: (t, {}) for n, t in (("face", "bigint"), ("t", "bigint"), ("sigma_layer", "bigint"), ("v", "double"))})


@query("prj_18_layer_midpoints", f"WITH lev AS (SELECT n_nationkey AS location, r_regionkey AS level, -r_regionkey / 4e0 AS sigma_level FROM nation CROSS JOIN region) SELECT location, level - 1 AS sigma_layer, {r6('(lag(sigma_level) OVER (PARTITION BY location ORDER BY level) + sigma_level) / 2e0')} AS sigma FROM lev QUALIFY level > 0")
def _(fx):
    levels = fx.table("nation").crossJoin(fx.table("region")).select(F.col("n_nationkey").alias("location"), F.col("r_regionkey").alias("level"), (-F.col("r_regionkey") / 4.0).alias("sigma_level"))
    return derive.layer_midpoints(levels)


def _corner_list() -> str:
    return ", ".join(f"{r6(f'{c}_{k}')} AS {c}_{k}" for c in ("lon", "lat") for k in (1, 2, 3))


@query("jn_1_node_to_face", f"WITH {CORNERS} SELECT face, {_corner_list()} FROM crn")
def _(fx):
    return derive.with_corner_coordinates(fx.face, fx.node).select("face", *(f"{c}_{k}" for c in ("lon", "lat") for k in (1, 2, 3)))


@query("prj_19_corner_array", f"WITH {CORNERS} SELECT face, {r6('lon_1 + lon_2 + lon_3')} AS lon_sum, {r6('(lat_1 + lat_2 + lat_3) / 3e0')} AS lat_center FROM crn")
def _(fx):
    out = derive.with_corner_coordinates(fx.face, fx.node).withColumn("c", F.array(*(F.struct(F.col(f"lon_{k}").alias("lon"), F.col(f"lat_{k}").alias("lat")) for k in (1, 2, 3))))
    add = lambda name: F.aggregate("c", F.lit(0.0), lambda s, x: s + x[name])
    return out.select("face", add("lon").alias("lon_sum"), (add("lat") / 3).alias("lat_center"))


@query("jn_2_zeta_center", f"SELECT face, t, {r6('zeta_center')} AS zeta_center FROM fx_zeta_center")
def _(fx):
    return derive.surface_at_faces(fx.zeta, fx.face).select("face", "t", "zeta_center")


@query("jn_4_corners_on_summary", f"WITH {CORNERS}, s AS (SELECT face, avg(speed) AS mean_speed FROM fx_layer GROUP BY face) SELECT s.face, {r6('mean_speed')} AS mean_speed, {_corner_list()} FROM s JOIN crn ON crn.face = s.face")
def _(fx):
    means = derive.with_flow(fx.velocity).groupBy("face").agg(F.avg("speed").alias("mean_speed"))
    return means.join(derive.with_corner_coordinates(fx.face, fx.node), "face").select("face", "mean_speed", *(f"{c}_{k}" for c in ("lon", "lat") for k in (1, 2, 3)))


@query("prj_20_face_id", "SELECT c_custkey AS face, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS face_id FROM customer")
def _(fx):
    return fx.points.select("face", derive.face_id(F.col("face")).alias("face_id"))


@query("prj_21_hours", f"SELECT face, t, {r6('t * 1800e0 / 3600')} AS hours FROM fx_zeta_center")
def _(fx):
    return derive.surface_at_faces(fx.zeta, fx.face).select("face", "t", derive.hours(F.col("t") * 1800.0).alias("hours"))


@query("prj_22_unit_label", """WITH n AS (SELECT p_partkey AS k, ['mean_speed','power_density','to_direction','sea_floor_depth','tidal_period','p_size'][1 + p_partkey % 6] AS name FROM part)
    SELECT k, name, CASE WHEN name = 'power_density' THEN 'W/m2' WHEN name = 'to_direction' THEN 'degrees' WHEN name = 'sea_floor_depth' THEN 'm' WHEN name = 'tidal_period' THEN 'h' WHEN name = 'mean_speed' THEN 'm/s' ELSE '1' END AS unit FROM n""")
def _(fx):
    names = F.array(*map(F.lit, ["mean_speed", "power_density", "to_direction", "sea_floor_depth", "tidal_period", "p_size"]))
    rows = fx.table("part").select(F.col("p_partkey").alias("k"), F.element_at(names, (F.col("p_partkey") % 6 + 1).cast("int")).alias("name"))
    return rows.withColumn("unit", derive.unit_label(F.col("name")))


@query("prj_23_sampled_vectors", f"""WITH a AS (SELECT face, t, sigma_layer, u, v, speed, least(greatest(speed * 3e0, 1e-1), 5e0) AS arrow FROM fx_layer WHERE face % 10 = 0)
    SELECT face, t, sigma_layer, {r6('arrow')} AS arrow, {r6('CASE WHEN speed > 0 THEN u / speed * arrow END')} AS dx, {r6('CASE WHEN speed > 0 THEN v / speed * arrow END')} AS dy FROM a""")
def _(fx):
    flow = derive.with_flow(fx.velocity)
    return derive.sampled_vectors(flow, 10, F.col("speed") * 3.0, 0.1, 5.0).select("face", "t", "sigma_layer", "arrow", "dx", "dy")


@query("prj_24_atlas_columns", f"SELECT {r6('max(speed)')} AS max_speed, {r6('avg(speed)')} AS mean_speed, face FROM fx_layer GROUP BY face")
def _(fx):
    rows = derive.with_flow(fx.velocity).groupBy("face").agg(F.avg("speed").alias("mean_speed"), F.max("speed").alias("max_speed"))
    order = ["face", "mean_speed", "max_speed"]
    return rows.select(*reversed(order))


@query("agg_13_boundary_edges", """WITH e AS (SELECT least(n1,n2) a, greatest(n1,n2) b FROM fx_face UNION ALL SELECT least(n2,n3), greatest(n2,n3) FROM fx_face UNION ALL SELECT least(n3,n1), greatest(n3,n1) FROM fx_face)
    SELECT a, b FROM e GROUP BY a, b HAVING count(*) = 1""")
def _(fx):
    return summary.boundary_edges(fx.face)
