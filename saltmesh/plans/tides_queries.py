"""Queries of flood and ebb, directions, peaks, levels and periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, r6
from ..operators import derive, tides
from .flow_queries import DIRECTION

W = "PARTITION BY face ORDER BY t"
PHASE = f"""grad AS (SELECT face, t, zeta_center, round(coalesce((lead(zeta_center) OVER ({W}) - lag(zeta_center) OVER ({W})) / 2e0, lead(zeta_center) OVER ({W}) - zeta_center, zeta_center - lag(zeta_center) OVER ({W})), 9) AS g FROM fx_zeta_center),
    phase AS (SELECT face, t, g, CASE WHEN g > 0 THEN 'flood' WHEN g < 0 THEN 'ebb' END AS phase FROM grad)"""
DIRECTED = f"dirs AS (SELECT face, t, sigma_layer, speed, {DIRECTION} AS d FROM fx_layer)"


def surface(fx):
    return derive.surface_at_faces(fx.zeta, fx.face)


def phased(fx):
    """Flow with the phase of its face and time."""
    return derive.with_flow(fx.velocity).drop("time").join(tides.tide_phase(surface(fx), ["face"]).select("face", "t", "phase"), ["face", "t"]).where("phase is not null")


@query("win_2_tide_phase", f"WITH {PHASE} SELECT face, t, {r6('g')} AS gradient, phase FROM phase")
def _(fx):
    return tides.tide_phase(surface(fx), ["face"]).select("face", "t", "gradient", "phase")


MODES = """bins AS (SELECT face, sigma_layer, phase, CAST(least(floor(d / 2e0), 179) AS BIGINT) AS bin, count(*) AS n, avg(speed) AS ms, sum(CASE WHEN speed >= 5e-1 THEN 1e0 ELSE 0e0 END) AS h FROM dirs JOIN phase USING (face, t) WHERE d IS NOT NULL AND phase IS NOT NULL GROUP BY 1, 2, 3, 4),
    modes AS (SELECT *, sum(h) OVER (PARTITION BY face, sigma_layer, phase) AS hours, row_number() OVER (PARTITION BY face, sigma_layer, phase ORDER BY n DESC, bin) AS rn FROM bins)"""


@query("agg_14_flood_ebb", f"WITH {PHASE}, {DIRECTED}, {MODES} SELECT face, sigma_layer, phase, {r6('bin * 2e0')} AS direction, {r6('ms')} AS mean_speed, n, {r6('hours')} AS moving_hours FROM modes WHERE rn = 1")
def _(fx):
    return tides.direction_modes(phased(fx), ["face", "sigma_layer", "phase"])


@query("agg_16_direction_over_layers", f"WITH {PHASE}, {DIRECTED}, {MODES} SELECT face, phase, {r6('avg(bin * 2e0)')} AS direction, {r6('avg(ms)')} AS mean_speed FROM modes WHERE rn = 1 GROUP BY 1, 2")
def _(fx):
    modes = tides.direction_modes(phased(fx), ["face", "sigma_layer", "phase"])
    return modes.groupBy("face", "phase").agg(tides.mean_direction(F.col("direction"), circular=False).alias("direction"), F.avg("mean_speed").alias("mean_speed"))


@query("agg_16_circular_mean", f"""WITH {DIRECTED}, m AS (SELECT face, degrees(atan2(avg(sin(radians(d))), avg(cos(radians(d))))) AS a FROM dirs WHERE sigma_layer = 0 GROUP BY face)
    SELECT face, (round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 4) + 0e0) AS direction FROM m""")
def _(fx):
    rows = derive.with_flow(fx.velocity).where("sigma_layer = 0").groupBy("face").agg(tides.mean_direction(F.col("to_direction")).alias("direction"))
    return rows.withColumn("direction", F.round("direction", 4))


@query("agg_15_primary_secondary", f"""WITH {DIRECTED}, b AS (SELECT face, CAST(least(floor(d / 2e0), 179) AS BIGINT) AS bin, count(*) AS n FROM dirs WHERE d IS NOT NULL GROUP BY 1, 2),
    p AS (SELECT *, first(bin) OVER (PARTITION BY face ORDER BY n DESC, bin) * 2e0 AS prim FROM b), q AS (SELECT *, least(abs(bin * 2e0 - prim), 360 - abs(bin * 2e0 - prim)) > 90 AS far FROM p),
    s AS (SELECT *, row_number() OVER (PARTITION BY face, far ORDER BY n DESC, bin) AS rn FROM q)
    SELECT face, {r6('min(prim)')} AS primary_direction, {r6('max(CASE WHEN far THEN bin * 2e0 END)')} AS secondary_direction FROM s WHERE rn = 1 GROUP BY face""")
def _(fx):
    return tides.primary_and_secondary(derive.with_flow(fx.velocity), ["face"])


@query("win_9_bin_rank", f"""WITH {DIRECTED}, b AS (SELECT face, CAST(least(floor(d / 2e0), 179) AS BIGINT) AS bin, count(*) AS n FROM dirs WHERE d IS NOT NULL GROUP BY 1, 2)
    SELECT face, bin, n, CAST(row_number() OVER (PARTITION BY face ORDER BY n DESC, bin) AS INT) AS rank  FROM b""")
def _(fx):
    from pyspark.sql import Window

    rows = derive.with_flow(fx.velocity).where("to_direction is not null")
    bins = rows.groupBy("face", F.least(F.floor(F.col("to_direction") / 2.0), F.lit(179)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    return bins.withColumn("rank", F.row_number().over(Window.partitionBy("face").orderBy(F.desc("n"), "bin")))


@query("scl_37_angular_difference", f"WITH {DIRECTED} SELECT face, t, sigma_layer, {r6('least(abs(d - 45), 360 - abs(d - 45))')} AS off FROM dirs")
def _(fx):
    return derive.with_flow(fx.velocity).select("face", "t", "sigma_layer", tides.angular_difference(F.col("to_direction"), F.lit(45.0)).alias("off"))


# Peaks in SQL: runs of equal levels, those higher than both neighbours, and for each the least level back to the last higher
# run on either side. Levels are rounded in both, so that plateaus are the same.
PEAKS = """z AS (SELECT face, t, time, round(zeta_center, 9) AS z FROM fx_zeta_center),
    marked AS (SELECT *, row_number() OVER w - 1 AS i, CASE WHEN z = lag(z) OVER w THEN 0 ELSE 1 END AS turn FROM z WINDOW w AS (PARTITION BY face ORDER BY t)),
    numbered AS (SELECT *, sum(turn) OVER (PARTITION BY face ORDER BY t) AS r FROM marked),
    sides AS (SELECT face, i, r, z, true AS is_high FROM numbered UNION ALL SELECT face, i, r, -z, false FROM numbered),
    runs AS (SELECT face, is_high, r, z, min(i) AS head, max(i) AS tail FROM sides GROUP BY face, is_high, r, z),
    tops AS (SELECT * FROM (SELECT *, lag(z) OVER w AS before, lead(z) OVER w AS after FROM runs WINDOW w AS (PARTITION BY face, is_high ORDER BY r)) WHERE z > before AND z > after),
    reach AS (SELECT p.face, p.is_high, p.r, p.z, p.head, p.tail, coalesce(max(CASE WHEN o.r < p.r THEN o.r END), 0) AS a, coalesce(min(CASE WHEN o.r > p.r THEN o.r END), 1000000000) AS b
        FROM tops p LEFT JOIN runs o ON o.face = p.face AND o.is_high = p.is_high AND o.z > p.z GROUP BY ALL),
    based AS (SELECT p.face, p.is_high, p.r, p.z, (p.head + p.tail) // 2 AS i, min(CASE WHEN o.r <= p.r THEN o.z END) AS x, min(CASE WHEN o.r >= p.r THEN o.z END) AS y
        FROM reach p JOIN runs o ON o.face = p.face AND o.is_high = p.is_high AND o.r > p.a AND o.r < p.b GROUP BY ALL),
    peaks AS (SELECT n.face, n.t, n.time, n.z AS level, q.is_high FROM based q JOIN numbered n ON n.face = q.face AND n.i = q.i WHERE q.z - greatest(q.x, q.y) >= 0.05e0),
    highs AS (SELECT *, lead(t) OVER (PARTITION BY face ORDER BY t) AS next_t, lead(time) OVER (PARTITION BY face ORDER BY t) AS next_high FROM peaks WHERE is_high),
    cycles AS (SELECT h.face, h.t, h.time, h.level AS high, h.next_high, min(l.level) AS low, (epoch_us(h.next_high) - epoch_us(h.time)) / 3.6e9 AS period_hours
        FROM highs h LEFT JOIN peaks l ON l.face = h.face AND NOT l.is_high AND l.t > h.t AND l.t < h.next_t GROUP BY ALL),
    whole AS (SELECT face, avg(z) AS msl, max(z) - min(z) AS extremes FROM z GROUP BY face),
    sided AS (SELECT face, count(*) FILTER (is_high) AS nh, count(*) FILTER (NOT is_high) AS nl FROM peaks GROUP BY face),
    ranked AS (SELECT z.face, z.z AS level, row_number() OVER (PARTITION BY z.face ORDER BY z.z DESC, z.t DESC) AS up, row_number() OVER (PARTITION BY z.face ORDER BY z.z, z.t) AS down, greatest(1, CAST(floor(count(*) OVER (PARTITION BY z.face) * 0.2e0) AS BIGINT)) AS k
        FROM z LEFT JOIN sided s ON s.face = z.face WHERE coalesce(s.nh, 0) = 0 OR coalesce(s.nl, 0) = 0),
    used AS (SELECT p.face, p.level, p.is_high, 'peaks' AS method FROM peaks p JOIN sided s ON s.face = p.face WHERE nh > 0 AND nl > 0
        UNION ALL SELECT face, level, true, 'top_share' FROM ranked WHERE up <= k UNION ALL SELECT face, level, false, 'top_share' FROM ranked WHERE down <= k),
    levels AS (SELECT w.face, max(level) FILTER (is_high) - msl AS max_high, min(level) FILTER (is_high) - msl AS min_high, avg(level) FILTER (is_high) - msl AS mean_high,
        max(level) FILTER (NOT is_high) - msl AS max_low, avg(level) FILTER (NOT is_high) - msl AS mean_low, min(level) FILTER (NOT is_high) - msl AS min_low, extremes AS range_extremes, msl AS msl_offset, max(method) AS method
        FROM whole w JOIN used u ON u.face = w.face GROUP BY w.face, msl, extremes),
    accepted AS (SELECT *, CASE WHEN (period_hours > 10 AND period_hours < 14) OR (period_hours > 20 AND period_hours < 26) THEN period_hours END AS p FROM cycles),
    periods AS (SELECT w.face, count(p) AS n_periods, avg(p) AS mean_period, min(p) AS min_period, max(p) AS max_period, count(low) AS n_cycles, avg(high - low) AS mean_range, min(high - low) AS min_range, max(high - low) AS max_range
        FROM whole w LEFT JOIN accepted a ON a.face = w.face GROUP BY w.face)"""
LEVEL_NAMES = ["max_high", "min_high", "mean_high", "max_low", "mean_low", "min_low"]
LEVELS = f"face, {', '.join(f'{r6(c)} AS {c}' for c in LEVEL_NAMES)}, {r6('max_high - min_low')} AS range_peaks, {r6('range_extremes')} AS range_extremes, {r6('msl_offset')} AS msl_offset, 0e0 AS mean_water, method"
_shown = lambda c: f"{r6(f'CASE WHEN n_periods > 0 THEN coalesce({c}, 0e0) ELSE 0e0 END')} AS {c}"
PERIODS = f"""n_periods, n_cycles, {', '.join(map(_shown, ['mean_period', 'min_period', 'max_period', 'mean_range', 'min_range', 'max_range']))},
    CASE WHEN n_periods = 0 THEN 'Unknown' WHEN mean_period > 10 AND mean_period < 14 THEN 'Twice Daily Tides' WHEN mean_period > 20 AND mean_period < 26 THEN 'Once Daily Tides' ELSE 'Mixed Pattern Tides' END AS type"""


def found_peaks(fx):
    return tides.peaks(surface(fx).withColumn("zeta_center", F.round("zeta_center", 9)))


@query("udf_1_peaks", f"WITH {PEAKS} SELECT face, t, time, {r6('level')} AS level, is_high FROM peaks")
def _(fx):
    return found_peaks(fx).where("is_peak").select("face", "t", "time", "level", "is_high")


@query("agg_17_tidal_levels", f"WITH {PEAKS} SELECT {LEVELS} FROM levels")
def _(fx):
    return tides.tidal_levels(found_peaks(fx)).withColumn("mean_water", F.abs(F.round("mean_water", 6)))


WARNED = """concat_ws('; ', CASE WHEN max_high - min_low < 0.1e0 THEN 'range under 0.1 m' END, CASE WHEN max_high - min_low > 15 THEN 'range over 15 m' END,
    CASE WHEN mean_high <= mean_low THEN 'mean high water not over mean low water' END)"""


@query("flt_30_level_warnings", f"WITH {PEAKS} SELECT {LEVELS}, {WARNED} AS warnings FROM levels")
def _(fx):
    warned = tides.level_warnings(tides.tidal_levels(found_peaks(fx)))
    return warned.withColumns({"warnings": F.array_join("warnings", "; "), "mean_water": F.abs(F.round("mean_water", 6))})


@query("win_4_tidal_cycles", f"WITH {PEAKS} SELECT face, t, time, {r6('high')} AS high, {r6('low')} AS low, {r6('high - low')} AS range, {r6('period_hours')} AS period_hours FROM cycles WHERE low IS NOT NULL")
def _(fx):
    return tides.tidal_cycles(found_peaks(fx)).drop("low_time")


@query("agg_18_tidal_periods", f"WITH {PEAKS} SELECT face, {PERIODS} FROM periods")
def _(fx):
    return tides.tidal_periods(found_peaks(fx))


@query("agg_19_surface_report", f"WITH {PEAKS} SELECT * FROM (SELECT {LEVELS} FROM levels) JOIN (SELECT face, {PERIODS} FROM periods) USING (face)")
def _(fx):
    return tides.surface_report(found_peaks(fx)).withColumn("mean_water", F.abs(F.round("mean_water", 6)))
