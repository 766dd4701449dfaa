"""Queries of checks on time axes, padding, gaps and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, r6
from ..operators import time_checks as tc
from ..sources.scratch import broadcast_if_few

EV = "ev AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, value) AS pos FROM events)"
# An axis of hourly steps per file of 25 steps; every 97th and 75th step is lost and every 61st stands twice.
AXIS = """axis AS (SELECT t // 25 AS file, t, t * 10 AS pos, TIMESTAMP '2005-01-01 00:00:00' + to_hours(CAST(t AS INT)) AS time FROM (SELECT DISTINCT t FROM fx_velocity) a WHERE t % 97 <> 96 AND t % 75 <> 74
    UNION ALL SELECT t // 25, t, t * 10 + 1, TIMESTAMP '2005-01-01 00:00:00' + to_hours(CAST(t AS INT)) FROM (SELECT DISTINCT t FROM fx_velocity) a WHERE t % 61 = 7)"""
EPOCH = "epoch_us({}) / 1e6"
START = "2005-01-01 00:00:00"


def axis(fx):
    steps = fx.velocity.select("t", "time").distinct().withColumn("file", F.floor(F.col("t") / 25))
    once = steps.where("t % 97 <> 96 and t % 75 <> 74").withColumn("pos", F.col("t") * 10)
    return once.unionByName(steps.where("t % 61 = 7").withColumn("pos", F.col("t") * 10 + 1)).select("file", "t", "pos", "time")


def events(fx):
    from pyspark.sql import Window

    rows = fx.table("events")
    return rows.select("user_id", "ts", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "value")).alias("pos"))


def steps_sql(source: str, keys: str, time: str, order: str) -> str:
    return f"st AS (SELECT *, epoch_us({time}) / 1e6 - lag(epoch_us({time})) OVER (PARTITION BY {keys} ORDER BY {order}) / 1e6 AS step FROM {source})"


@query("flt_1_monotone", f"WITH {AXIS}, {steps_sql('axis', 'file', 'time', 'pos')} SELECT file, t, pos FROM st WHERE step <= 0")
def _(fx):
    return tc.not_increasing(axis(fx), ["file"], "time", "pos").select("file", "t", "pos")


@query("flt_2_duplicate_times", "SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, count(*) AS n FROM (SELECT user_id, date_trunc('hour', ts) AS ts FROM events) e GROUP BY 1, 2 HAVING count(*) > 1")
def _(fx):
    rows = fx.table("events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return tc.duplicates(rows, ["user_id", "ts"])


STATS = f"WITH {EV}, {steps_sql('ev', 'user_id', 'ts', 'pos')} SELECT user_id, {r6('avg(step)')} AS mean_step, {r6('min(step)')} AS min_step, {r6('max(step)')} AS max_step, count(*) AS n_steps FROM st WHERE step IS NOT NULL GROUP BY user_id"


@query("flt_3_step_statistics", STATS)
def _(fx):
    return tc.step_statistics(events(fx), ["user_id"], "ts", "pos")


@query("win_1_steps", f"WITH {EV}, {steps_sql('ev', 'user_id', 'ts', 'pos')} SELECT user_id, CAST(pos AS INT) AS pos, {r6('step')} AS step FROM st")
def _(fx):
    return tc.with_step(events(fx), ["user_id"], "ts", "pos").select("user_id", "pos", "step")


@query("flt_4_off_specification", f"WITH {AXIS}, {steps_sql('axis', 'file', 'time', 'pos')}, a AS (SELECT file, avg(step) AS m, min(step) AS lo, max(step) AS hi FROM st WHERE step IS NOT NULL GROUP BY file) SELECT file, {r6('m')} AS mean_step, {r6('lo')} AS min_step, {r6('hi')} AS max_step FROM a WHERE abs(m - 3600) > 1e-3 OR abs(lo - 3600) > 1e-3 OR abs(hi - 3600) > 1e-3")
def _(fx):
    return tc.off_specification(tc.step_statistics(axis(fx), ["file"], "time", "pos"), 3600.0).drop("n_steps")


@query("flt_5_spacing_label", f"""WITH {AXIS}, {steps_sql('axis', 'file', 'time', 'pos')}, a AS (SELECT file, arg_min(step, pos) AS f, min(step) AS lo, max(step) AS hi FROM st WHERE step IS NOT NULL GROUP BY file)
    SELECT file, {r6('f')} AS first_step, CASE WHEN lo <> f OR hi <> f THEN 'irregular' WHEN f = 3600 THEN '1h' WHEN f = 1800 THEN '30m' ELSE CAST(CAST(f AS BIGINT) AS VARCHAR) || 's' END AS label FROM a""")
def _(fx):
    return tc.spacing_label(axis(fx), ["file"], "time", "pos").select("file", "first_step", "label")


@query("flt_6_incomplete_series", f"""WITH {AXIS}, {steps_sql('axis', 'file', 'time', 'pos')}, a AS (SELECT file, min(time) AS f, max(time) AS l, min(step) AS lo, max(step) AS hi FROM st GROUP BY file)
    SELECT file, CASE WHEN f > s THEN 'starts late' WHEN l < e THEN 'ends early' ELSE 'uneven steps' END AS problem FROM (SELECT *, TIMESTAMP '{START}' + to_hours(CAST(file * 25 AS INT)) AS s, TIMESTAMP '{START}' + to_hours(CAST(file * 25 + 24 AS INT)) AS e FROM a) b WHERE f > s OR l < e OR lo <> 3600 OR hi <> 3600""")
def _(fx):
    rows = axis(fx)
    start = F.lit(START).cast("timestamp_ntz")
    at = lambda h: (start + F.make_dt_interval(hours=h.cast("int"))).cast("timestamp_ntz")
    spec = rows.select("file").distinct().select("file", at(F.col("file") * 25).alias("start"), at(F.col("file") * 25 + 24).alias("end"), F.lit(3600.0).alias("step"))
    stepped = tc.incomplete(rows, ["file"], "time", spec)
    return stepped.select("file", "problem")


FILES = f"{AXIS}, files AS (SELECT file, min(time) AS a, max(time) AS b, count(*) AS n FROM axis GROUP BY file)"


@query("flt_7_file_continuity", f"WITH {FILES}, g AS (SELECT file, (epoch_us(a) - lag(epoch_us(b)) OVER (ORDER BY file)) / 1e6 AS gap FROM files) SELECT file, {r6('gap')} AS gap FROM g WHERE abs(gap - 3600) > 1e-3")
def _(fx):
    files = axis(fx).groupBy("file").agg(F.min("time").alias("first"), F.max("time").alias("last"), F.count("*").alias("n")).withColumn("location", F.lit("site"))
    return tc.broken_continuity(files, 3600.0).select("file", "gap")


@query("flt_20_time_window", f"SELECT face, sigma_layer, count(*) AS n, {r6('avg(u)')} AS mean_u FROM fx_velocity WHERE time BETWEEN TIMESTAMP '2005-01-01 06:00:00' AND TIMESTAMP '2005-01-04 05:00:00' GROUP BY 1, 2")
def _(fx):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    rows = tc.in_window(fx.velocity, "time", at("2005-01-01 06:00:00"), at("2005-01-04 05:00:00"))
    return rows.groupBy("face", "sigma_layer").agg(F.count("*").alias("n"), F.avg("u").alias("mean_u"))


@query("flt_21_first_of_duplicates", f"WITH {AXIS} SELECT file, t, min(pos) AS pos FROM axis GROUP BY file, t")
def _(fx):
    return tc.first_of_each(axis(fx), ["time"], "pos").select("file", "t", "pos")


@query("flt_35_per_file_time", f"WITH {AXIS}, {steps_sql('axis', 'file', 'time', 'pos')} SELECT file, {r6('avg(step)')} AS mean_step, count(*) FILTER (WHERE step <= 0) AS backward FROM st GROUP BY file HAVING avg(step) <> 3600 OR count(*) FILTER (WHERE step <= 0) > 0")
def _(fx):
    rows = tc.with_step(axis(fx), ["file"], "time", "pos")
    out = rows.groupBy("file").agg(F.avg("step").alias("mean_step"), F.count(F.when(F.col("step") <= 0, 1)).alias("backward"))
    return out.where("mean_step <> 3600 or backward > 0")


@query("win_3_synthesised_time", f"""WITH f AS (SELECT c_nationkey AS location, c_custkey // 25 AS file, count(*) AS n_steps FROM customer GROUP BY 1, 2), o AS (SELECT *, coalesce(sum(n_steps) OVER (PARTITION BY location ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM f)
    SELECT location, file, CAST(pos AS INT) AS pos, TIMESTAMP '{START}' + to_minutes(CAST(30 * (off + pos) AS INT)) AS time FROM (SELECT *, unnest(range(n_steps)) AS pos FROM o) x""")
def _(fx):
    files = fx.table("customer").groupBy(F.col("c_nationkey").alias("location"), F.floor(F.col("c_custkey") / 25).alias("file")).agg(F.count("*").alias("n_steps"))
    return tc.synthesised(files, F.lit(START).cast("timestamp_ntz"), 1800)


LINE = f"line AS (SELECT t, TIMESTAMP '{START}' + to_hours(CAST(t AS INT)) AS time FROM (SELECT unnest(range(min(t), max(t) + 1)) AS t FROM fx_zeta_center) s)"


def _expected(fx):
    ends = fx.velocity.agg(F.min("time").alias("start"), F.max("time").alias("end"))
    return tc.timeline(ends, "1 HOUR")


@query("jn_6_padded_year", f"WITH {LINE}, z AS (SELECT face, time, zeta_center FROM fx_zeta_center WHERE t % 11 <> 4) SELECT f.face, l.time, {r6('coalesce(z.zeta_center, -999e0)')} AS zeta_center FROM line l CROSS JOIN (SELECT DISTINCT face FROM z) f LEFT JOIN z ON z.time = l.time AND z.face = f.face")
def _(fx):
    from ..operators import derive

    rows = derive.surface_at_faces(fx.zeta, fx.face).where("t % 11 <> 4").select("face", "time", "zeta_center")
    expected = rows.select("face").distinct().crossJoin(F.broadcast(_expected(fx)))
    return tc.padded(rows, expected, ["face", "time"], ["zeta_center"]).select("face", "time", "zeta_center")


@query("flt_27_expected_timeline", f"WITH {LINE}, {AXIS} SELECT l.time, 'missing' AS side FROM line l WHERE l.time NOT IN (SELECT time FROM axis) UNION ALL SELECT time, 'extra' FROM axis WHERE time NOT IN (SELECT time FROM line)")
def _(fx):
    return tc.unmatched(_expected(fx), axis(fx), ["time"])


GONE = "gone AS (SELECT c_nationkey AS k, c_custkey // 25 AS i FROM customer WHERE c_custkey % 7 <> 3 GROUP BY 1, 2)"
ISLANDS = f"{GONE}, isl AS (SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS g FROM gone), runs AS (SELECT k, min(i) AS first, max(i) AS last, count(*) AS n FROM isl GROUP BY k, g)"


def gone(fx):
    return fx.table("customer").where("c_custkey % 7 <> 3").select(F.col("c_nationkey").alias("k"), F.floor(F.col("c_custkey") / 25).alias("i")).distinct()


@query("win_5_gap_ranges", f"WITH {ISLANDS} SELECT k, first, last, n FROM runs")
def _(fx):
    return tc.ranges(gone(fx), ["k"], "i")


@query("win_6_range_text", f"WITH {ISLANDS} SELECT k, string_agg(CASE WHEN first = last THEN CAST(first AS VARCHAR) ELSE CAST(first AS VARCHAR) || '-' || CAST(last AS VARCHAR) END, ',' ORDER BY first) AS indices FROM runs GROUP BY k")
def _(fx):
    return tc.range_text(tc.ranges(gone(fx), ["k"], "i"), ["k"])


@query("win_10_first_time", "SELECT face % 5 AS product, min(time) AS first_time FROM fx_velocity GROUP BY 1")
def _(fx):
    return fx.velocity.groupBy((F.col("face") % 5).alias("product")).agg(F.min("time").alias("first_time"))


@query("win_11_frame_selection", "WITH s AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT t FROM fx_velocity) d), f AS (SELECT DISTINCT CAST(floor(k * (n - 1) / 9e0) AS BIGINT) AS i FROM s CROSS JOIN (SELECT unnest(range(10)) AS k) r) SELECT s.t FROM s JOIN f ON f.i = s.i")
def _(fx):
    times = fx.velocity.select("t").distinct()
    # The axis of a site-year has some 17,000 steps: one small sort.
    from pyspark.sql import Window

    rows = times.withColumn("i", F.row_number().over(Window.orderBy("t")) - 1)
    n = times.agg(F.count("*").alias("n")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9))))
    frames = n.select(F.floor(F.col("k") * (F.col("n") - 1) / 9.0).alias("i")).distinct()
    return rows.join(frames, "i").select("t")


BATCHES = "bat AS (SELECT c_nationkey AS location, c_custkey // 50 * 50 AS s, c_custkey // 50 * 50 + 49 AS e FROM customer GROUP BY 1, 2, 3)"


def batches(fx):
    start = F.floor(F.col("c_custkey") / 50) * 50
    return fx.table("customer").select(F.col("c_nationkey").alias("location"), start.alias("start"), (start + 49).alias("end")).distinct()


@query("flt_23_batch_gaps", f"WITH {BATCHES}, w AS (SELECT location, s, e, coalesce(lag(e) OVER (PARTITION BY location ORDER BY s) + 1, 0) AS wanted FROM bat) SELECT location, s AS start, wanted FROM w WHERE s <> wanted")
def _(fx):
    return tc.batch_gaps(batches(fx)).select("location", "start", "wanted")


@query("flt_22_face_range", f"SELECT face, {r6('sum(u)')} AS total FROM fx_velocity WHERE face BETWEEN 10 AND 19 GROUP BY face")
def _(fx):
    return fx.velocity.where(F.col("face").between(10, 19)).groupBy("face").agg(F.sum("u").alias("total"))


@query("set_1_missing_batches", f"WITH {BATCHES} SELECT n_nationkey AS location, s FROM nation CROSS JOIN (SELECT DISTINCT s FROM bat) b EXCEPT SELECT location, s FROM bat")
def _(fx):
    found = batches(fx).select("location", F.col("start").alias("s"))
    expected = fx.table("nation").select(F.col("n_nationkey").alias("location")).crossJoin(broadcast_if_few(found.select("s").distinct()))
    return tc.missing_batches(expected, found, ["location", "s"])


@query("flt_8_coordinates_across_files", "WITH c AS (SELECT o_custkey AS face, o_orderkey % 3 AS file, CASE WHEN o_orderkey % 1000 = 1 THEN 1 ELSE 0 END + o_custkey * 1e-1 AS lat FROM orders) SELECT face FROM c GROUP BY face HAVING min(lat) <> max(lat)")
def _(fx):
    lat = F.when(F.col("o_orderkey") % 1000 == 1, 1).otherwise(0) + F.col("o_custkey") * 0.1
    rows = fx.table("orders").select(F.col("o_custkey").alias("face"), lat.alias("lat"))
    return tc.changed_between_files(rows, ["face"], ["lat"]).select("face")


@query("flt_19_constant_changes", "SELECT l_orderkey % 100 AS k FROM lineitem GROUP BY 1 HAVING min(l_linenumber) <> max(l_linenumber)")
def _(fx):
    rows = fx.table("lineitem").select((F.col("l_orderkey") % 100).alias("k"), "l_linenumber")
    return tc.changed_between_files(rows, ["k"], ["l_linenumber"]).select("k")


@query("agg_33_expected_partitions", f"WITH e AS (SELECT min(time) AS a, max(time) AS b FROM fx_velocity) SELECT date_diff('month', a, b) + 1 AS months, CAST(floor(date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) / 5) AS BIGINT) + 1 AS five_days FROM e")
def _(fx):
    e = fx.velocity.agg(F.min("time").alias("a"), F.max("time").alias("b"))
    months = F.size(F.sequence(F.trunc(F.to_date("a"), "month"), F.trunc(F.to_date("b"), "month"), F.expr("INTERVAL 1 MONTH")))
    days = F.size(F.sequence(F.to_date("a"), F.to_date("b"), F.expr("INTERVAL 5 DAYS")))
    return e.select(months.cast("long").alias("months"), days.cast("long").alias("five_days"))


@query("scl_45_time_strings", "SELECT t, strftime(time, '%Y-%m-%dT%H:%M:%S') AS text, time FROM (SELECT DISTINCT t, time FROM fx_velocity) s")
def _(fx):
    steps = fx.velocity.select("t", "time").distinct()
    rows = steps.select("t", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss").alias("text"))
    return rows.withColumn("time", F.to_timestamp_ntz("text", F.lit("yyyy-MM-dd'T'HH:mm:ss")))


@query("scl_32_export_time", "SELECT t, strftime(time, '%Y-%m-%d %H:%M:%S') || '+00:00' AS text FROM (SELECT DISTINCT t, time FROM fx_velocity) s")
def _(fx):
    return fx.velocity.select("t", "time").distinct().select("t", F.date_format("time", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("text"))
