"""Queries of summaries, pivots, histograms and region statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, r6
from ..operators import derive, summary

LAYER_COLUMNS = ", ".join(f"{r6(f'max(CASE WHEN sigma_layer = {k} THEN m END)')} AS speed_sigma_level_{k}" for k in range(4))


def flow(fx):
    return derive.with_flow(fx.velocity)


@query("face_summary", f"""WITH c AS (SELECT face, t, max(speed) AS top, avg(5e-1 * 1025e0 * speed * speed * speed) AS power FROM fx_layer GROUP BY face, t)
    SELECT face, count(*) AS n, {r6('avg(top)')} AS mean_top_speed, {r6('quantile_cont(top, 95e-2)')} AS p95_top_speed, (round(avg(power), 4) + 0e0) AS mean_power FROM c GROUP BY face""")
def _(fx):
    """Layers to columns per time step first, then the year per face."""
    columns = flow(fx).groupBy("face", "t").agg(F.max("speed").alias("top"), F.avg("power_density").alias("power"))
    return columns.groupBy("face").agg(
        F.count("*").alias("n"), F.avg("top").alias("mean_top_speed"), F.percentile("top", F.lit(0.95)).alias("p95_top_speed"), F.round(F.avg("power"), 4).alias("mean_power")
    )


@query("agg_1_periods", """SELECT date_trunc('month', time) AS month, CAST(floor(date_diff('day', CAST(TIMESTAMP '2005-01-01 00:00:00' AS DATE), CAST(time AS DATE)) / 5) AS BIGINT) AS five_days, count(*) AS n, min(t) AS first_t
    FROM (SELECT DISTINCT t, time FROM fx_velocity) s GROUP BY 1, 2""")
def _(fx):
    first = F.lit("2005-01-01 00:00:00").cast("timestamp_ntz")
    steps = fx.velocity.select("t", "time").distinct()
    keys = [summary.period_month(F.col("time")).alias("month"), summary.period_days(F.col("time"), first, 5).alias("five_days")]
    return steps.groupBy(*keys).agg(F.count("*").alias("n"), F.min("t").alias("first_t"))


@query("agg_2_column_statistics", f"SELECT face, t, {r6('avg(speed)')} AS speed_mean, {r6('median(speed)')} AS speed_median, {r6('max(speed)')} AS speed_max, {r6('quantile_cont(speed, 95e-2)')} AS speed_p95 FROM fx_layer GROUP BY face, t")
def _(fx):
    return summary.column_statistics(flow(fx), "speed", ["face", "t"])


@query("udf_5_array_statistics", f"SELECT face, t, {r6('avg(speed)')} AS speed_mean, {r6('median(speed)')} AS speed_median, {r6('max(speed)')} AS speed_max, {r6('quantile_cont(speed, 95e-2)')} AS speed_p95 FROM fx_layer GROUP BY face, t")
def _(fx):
    profiles = flow(fx).groupBy("face", "t").agg(F.collect_list("speed").alias("speed"))
    return summary.column_statistics_of_arrays(profiles, "speed").drop("speed")


@query("agg_3_column_mean", f"SELECT face, t, {r6('avg(u)')} AS u_mean, {r6('avg(v)')} AS v_mean FROM fx_velocity GROUP BY face, t")
def _(fx):
    return fx.velocity.groupBy("face", "t").agg(F.avg("u").alias("u_mean"), F.avg("v").alias("v_mean"))


@query("agg_4_mean_over_files", f"SELECT face, sigma_layer, {r6('avg(speed)')} AS mean_speed, {r6('avg(u)')} AS mean_u FROM fx_layer GROUP BY 1, 2")
def _(fx):
    return flow(fx).groupBy("face", "sigma_layer").agg(F.avg("speed").alias("mean_speed"), F.avg("u").alias("mean_u"))


@query("agg_5_file_maxima", f"SELECT face, sigma_layer, t // 25 AS file, {r6('max(speed)')} AS file_max FROM fx_layer GROUP BY 1, 2, 3")
def _(fx):
    return summary.file_maxima(flow(fx), "speed", ["face", "sigma_layer"], F.floor(F.col("t") / 25))


@query("agg_6_p95_timestep", f"SELECT face, sigma_layer, count(*) AS n, {r6('avg(speed)')} AS mean, {r6('min(speed)')} AS min, {r6('max(speed)')} AS max, {r6('quantile_cont(speed, 95e-2)')} AS p95, {r6('quantile_cont(speed, 99e-2)')} AS p99 FROM fx_layer GROUP BY 1, 2")
def _(fx):
    return summary.summary(flow(fx), "speed", ["face", "sigma_layer"])


@query("agg_6_p95_file_max", f"WITH m AS (SELECT face, t // 25 AS file, max(speed) AS x FROM fx_layer GROUP BY 1, 2) SELECT face, {r6('max(x)')} AS max, {r6('quantile_cont(x, 95e-2)')} AS p95, {r6('quantile_cont(x, 99e-2)')} AS p99 FROM m GROUP BY face")
def _(fx):
    return summary.file_max_percentiles(flow(fx), "speed", ["face"], F.floor(F.col("t") / 25))


@query("agg_7_column_height", f"SELECT z.face, {r6('min(f.h_center + z.zeta_center)')} AS lowest, {r6('max(f.h_center + z.zeta_center)')} AS highest FROM fx_zeta_center z JOIN fx_face f ON f.face = z.face GROUP BY z.face")
def _(fx):
    height = F.col("h_center") + F.col("zeta_center")
    return derive.surface_at_faces(fx.zeta, fx.face).join(fx.face, "face").groupBy("face").agg(F.min(height).alias("lowest"), F.max(height).alias("highest"))


@query("agg_8_surface_layer", f"SELECT face, count(*) AS n, {r6('avg(speed)')} AS mean, {r6('min(speed)')} AS min, {r6('max(speed)')} AS max, {r6('quantile_cont(speed, 95e-2)')} AS p95, {r6('quantile_cont(speed, 99e-2)')} AS p99 FROM fx_layer WHERE sigma_layer = 0 GROUP BY face")
def _(fx):
    return summary.summary(flow(fx).where("sigma_layer = 0"), "speed", ["face"])


@query("agg_9_yearly_summary", f"""SELECT face, {r6('avg(speed)')} AS mean_speed, {r6('max(speed)')} AS max_speed, (round(avg(5e-1 * 1025e0 * speed * speed * speed), 4) + 0e0) AS mean_power,
    {r6('avg(CASE WHEN sigma_layer = 0 THEN speed END)')} AS surface_mean, {r6('max(CASE WHEN sigma_layer = 0 THEN speed END)')} AS surface_max FROM fx_layer GROUP BY face""")
def _(fx):
    surface = F.when(F.col("sigma_layer") == 0, F.col("speed"))
    return flow(fx).groupBy("face").agg(F.avg("speed").alias("mean_speed"), F.max("speed").alias("max_speed"), F.round(F.avg("power_density"), 4).alias("mean_power"), F.avg(surface).alias("surface_mean"), F.max(surface).alias("surface_max"))


@query("agg_10_monthly_yearly", f"""WITH x AS (SELECT CAST(year(time) AS INT) AS year, CAST(month(time) AS INT) AS month, face, speed FROM fx_layer)
    SELECT year, coalesce(month, 0) AS month, face, {r6('avg(speed)')} AS mean, {r6('max(speed)')} AS max, count(*) AS n FROM x GROUP BY GROUPING SETS ((year, month, face), (year, face))""")
def _(fx):
    return summary.monthly_and_yearly(flow(fx), "speed")


@query("agg_11_pivot_layers", f"WITH m AS (SELECT face, sigma_layer, avg(speed) AS m FROM fx_layer GROUP BY 1, 2) SELECT face, {LAYER_COLUMNS} FROM m GROUP BY face")
def _(fx):
    means = flow(fx).groupBy("face", "sigma_layer").agg(F.avg("speed").alias("speed"))
    return summary.pivot_layers(means, ["face"], "speed", [0, 1, 2, 3])


@query("agg_12_mean_surface", f"SELECT face, {r6('avg(zeta_center)')} AS mean_navd88_offset FROM fx_zeta_center GROUP BY face")
def _(fx):
    return derive.surface_at_faces(fx.zeta, fx.face).groupBy("face").agg(F.avg("zeta_center").alias("mean_navd88_offset"))


@query("agg_21_value_counts", "SELECT CAST(-9 + c_nationkey % 3 AS INT) AS timezone_offset, count(*) AS n FROM customer GROUP BY 1")
def _(fx):
    return summary.value_counts(fx.table("customer").select((F.col("c_nationkey") % 3 - 9).cast("int").alias("timezone_offset")), "timezone_offset")


@query("agg_25_region_statistics", f"""SELECT l_returnflag, count(*) AS n, {r6('min(x)')} AS min, {r6('max(x)')} AS max, (round(avg(x), 4) + 0e0) AS mean, (round(stddev_pop(x), 3) + 0e0) AS std,
    (round(quantile_cont(x, 95e-2), 4) + 0e0) AS p95, (round(quantile_cont(x, 99e-2), 4) + 0e0) AS p99, (round(quantile_cont(x, 9999e-4), 4) + 0e0) AS p9999
    FROM (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem) s GROUP BY 1""")
def _(fx):
    rows = fx.table("lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("x"))
    out = summary.region_statistics(rows, "l_returnflag", "x")
    return out.withColumns({**{c: F.round(c, 4) for c in ("mean", "p95", "p99", "p9999")}, "std": F.round("std", 3)})


@query("agg_26_region_comparison", f"""SELECT l_returnflag, count(*) AS n, (round(avg(x), 4) + 0e0) AS mean, {r6('max(x)')} AS max, (round(quantile_cont(x, 99e-2), 4) + 0e0) AS p99, (round(quantile_cont(x, 999e-3), 4) + 0e0) AS p999, {r6('100 * avg(CASE WHEN x <= 5e4 THEN 1e0 ELSE 0e0 END)')} AS kept_percent
    FROM (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem) s GROUP BY ROLLUP(l_returnflag)""")
def _(fx):
    rows = fx.table("lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("x"))
    out = summary.region_comparison(rows, "l_returnflag", "x", 5e4)
    return out.withColumns({"mean": F.round("mean", 4), "p99": F.round("p99", 4), "p999": F.round("p999", 4)})


@query("agg_27_stacked_histogram", """WITH r AS (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem), lim AS (SELECT max(x) * 115e-2 AS hi, least(60, CAST(floor(sqrt(count(*))) AS BIGINT)) AS n FROM r)
    SELECT l_returnflag, CAST(least(floor(x / (hi / n)), n - 1) AS BIGINT) AS bin, count(*) AS n FROM r CROSS JOIN lim GROUP BY 1, 2""")
def _(fx):
    return summary.stacked_histogram(fx.table("lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("x")), "l_returnflag", "x")


@query("agg_28_density_histogram", f"""WITH lim AS (SELECT sigma_layer, min(speed) AS lo, max(speed) AS hi, count(*) AS n FROM fx_layer GROUP BY 1)
    SELECT l.sigma_layer, CAST(least(floor((l.speed - m.lo) / ((m.hi - m.lo) / 50)), 49) AS BIGINT) AS bin, {r6('count(*) / (min(m.n) * (min(m.hi) - min(m.lo)) / 50)')} AS density FROM fx_layer l JOIN lim m ON m.sigma_layer = l.sigma_layer GROUP BY 1, 2""")
def _(fx):
    return summary.density_histogram(flow(fx), "sigma_layer", "speed")


@query("agg_29_power_statistics", """SELECT sigma_layer, (round(min(p), 4) + 0e0) AS min, (round(max(p), 4) + 0e0) AS max, (round(avg(p), 4) + 0e0) AS mean, (round(stddev_pop(p), 4) + 0e0) AS std, (round(median(p), 4) + 0e0) AS median, (round(quantile_cont(p, 95e-2), 4) + 0e0) AS p95, (round(quantile_cont(p, 99e-2), 4) + 0e0) AS p99
    FROM (SELECT sigma_layer, 5e-1 * 1025e0 * speed * speed * speed AS p FROM fx_layer) s GROUP BY 1""")
def _(fx):
    out = summary.basic_statistics(flow(fx), "power_density", ["sigma_layer"])
    return out.select("sigma_layer", *(F.round(c, 4).alias(c) for c in out.columns[1:]))


@query("agg_30_vertical_extent", f"SELECT {r6('max(f.h_center + z.zeta_center)')} AS vertical_max, {r6('-max(z.zeta_center)')} AS vertical_min FROM fx_zeta_center z JOIN fx_face f ON f.face = z.face")
def _(fx):
    rows = derive.surface_at_faces(fx.zeta, fx.face).join(fx.face, "face")
    return rows.agg(F.max(F.col("h_center") + F.col("zeta_center")).alias("vertical_max"), (-F.max("zeta_center")).alias("vertical_min"))


@query("agg_31_ledger_summary", "SELECT upload_status, '.parquet' AS extension, count(*) AS n_files, CAST(sum(file_size_bytes) AS BIGINT) AS n_bytes FROM fx_ledger GROUP BY 1")
def _(fx):
    return summary.ledger_summary(fx.ledger)


@query("agg_32_completeness", """WITH e AS (SELECT c_custkey % 6 AS location, 2500 + 100 * (c_custkey % 6) AS expected FROM customer GROUP BY 1, 2), f AS (SELECT o_custkey % 6 AS location, count(*) AS found FROM orders WHERE o_custkey % 6 <> 3 GROUP BY 1)
    SELECT e.location, e.expected, coalesce(f.found, 0) AS found, CASE WHEN coalesce(f.found, 0) = 0 THEN 'missing' WHEN f.found < e.expected THEN 'partial' ELSE 'complete' END AS status FROM e LEFT JOIN f ON f.location = e.location""")
def _(fx):
    expected = fx.table("customer").select((F.col("c_custkey") % 6).alias("location")).distinct().withColumn("expected", 2500 + 100 * F.col("location"))
    found = fx.table("orders").where("o_custkey % 6 <> 3").groupBy((F.col("o_custkey") % 6).alias("location")).agg(F.count("*").alias("found"))
    return summary.completeness(expected, found, "location")


@query("agg_34_bounding_box", f"""WITH b AS (SELECT face % 7 AS grp, min(lon) AS a, max(lon) AS b, min(lat) AS c, max(lat) AS d FROM fx_points GROUP BY 1)
    SELECT grp, {r6('a - (b - a) * 1e-1')} AS lon_min, {r6('b + (b - a) * 1e-1')} AS lon_max, {r6('c - (d - c) * 1e-1')} AS lat_min, {r6('d + (d - c) * 1e-1')} AS lat_max FROM b""")
def _(fx):
    return summary.bounding_box(fx.points.withColumn("grp", F.col("face") % 7), ["grp"])


@query("agg_35_dateline_shift", f"""WITH p AS (SELECT face % 5 AS grp, CASE WHEN face % 2 = 0 THEN 1795e-1 ELSE -1795e-1 END * (CASE WHEN face % 5 = 0 THEN 1e-1 ELSE 1e0 END) AS lon FROM fx_points)
    SELECT grp, {r6('min(lon)')} AS lo, {r6('max(lon)')} AS hi, {r6('max(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) - min(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END)')} AS moved_span,
    (min(lon) < 0 AND max(lon) > 0 AND max(lon) - min(lon) > 180 AND max(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) - min(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) < max(lon) - min(lon)) AS shift FROM p GROUP BY grp""")
def _(fx):
    f = F.col("face")
    lon = F.when(f % 2 == 0, 179.5).otherwise(-179.5) * F.when(f % 5 == 0, 0.1).otherwise(1.0)
    return summary.dateline_shift(fx.points.select((f % 5).alias("grp"), lon.alias("lon")), ["grp"])


@query("agg_37_by_variable", f"""WITH s AS (SELECT l_returnflag AS region, avg(CAST(l_quantity AS DOUBLE)) AS quantity, avg(CAST(l_discount AS DOUBLE)) AS discount FROM lineitem GROUP BY 1)
    SELECT region, 'quantity' AS statistic, {r6('quantity')} AS value FROM s UNION ALL SELECT region, 'discount', {r6('discount')} FROM s""")
def _(fx):
    stats = fx.table("lineitem").groupBy(F.col("l_returnflag").alias("region")).agg(F.avg(F.col("l_quantity").cast("double")).alias("quantity"), F.avg(F.col("l_discount").cast("double")).alias("discount"))
    return summary.spread_columns(stats, ["region"])


@query("agg_38_batches_by_name", """WITH f AS (SELECT file_index % 40 AS b, file_index AS start, s3_destination AS path FROM fx_ledger WHERE upload_status = 'failed')
    SELECT 'base' || CAST(b AS VARCHAR) AS base, string_agg(path, ',' ORDER BY start) AS paths FROM f GROUP BY b""")
def _(fx):
    base = F.concat(F.lit("base"), (F.col("file_index") % 40).cast("string"))
    files = fx.ledger.where("upload_status = 'failed'").select(base.alias("base"), F.col("file_index").alias("start"), F.col("s3_destination").alias("path"))
    return summary.batches_by_name(files).withColumn("paths", F.array_join("paths", ","))


@query("agg_39_layer_counts", """WITH s AS (SELECT n_name AS location, n_nationkey % 3 + 9 AS sigma_layers FROM nation), g AS (SELECT sigma_layers, count(*) AS n, string_agg(location, ',' ORDER BY location) AS locations FROM s GROUP BY 1)
    SELECT sigma_layers, n, locations, CAST(row_number() OVER (ORDER BY n DESC, sigma_layers) AS INT) AS rank FROM g""")
def _(fx):
    return summary.layer_count_groups(fx.table("nation").select(F.col("n_name").alias("location"), (F.col("n_nationkey") % 3 + 9).alias("sigma_layers")))
