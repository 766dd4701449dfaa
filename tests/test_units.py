"""Operators against plain restatements and known values."""

import itertools
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmesh.functions import dateline, geo, names
from saltmesh.operators import derive, spatial, summary, tides, tiles, time_checks
from saltmesh.sources import tables
from saltmesh.streaming import running_summary


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


@pytest.mark.parametrize(("u", "v", "to"), [(0, 1, 0), (1, 0, 90), (0, -1, 180), (-1, 0, 270), (1, 1, 45), (0.001, 0, None)])
def test_directions(spark, u, v, to):
    got = one(spark, d=derive.to_direction(F.lit(float(u)), F.lit(float(v))))["d"]
    assert got is None if to is None else abs(got - to) < 1e-9


def plain_peaks(x, prominence):
    """Maxima by plateaus, with prominence by walking out to the first higher value on each side."""
    out, n, k = [], len(x), 1
    while k < n - 1:
        if x[k - 1] < x[k]:
            e = k
            while e < n - 1 and x[e + 1] == x[k]:
                e += 1
            if e < n - 1 and x[e + 1] < x[k]:
                top, i, j = (k + e) // 2, k, e
                lo = x[k]
                while i >= 0 and x[i] <= x[k]:
                    lo = min(lo, x[i])
                    i -= 1
                hi = x[k]
                while j < n and x[j] <= x[k]:
                    hi = min(hi, x[j])
                    j += 1
                if x[k] - max(lo, hi) >= prominence:
                    out.append(top)
                k = e
        k += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.integers(0, 4))
def test_find_peaks(x, prominence):
    assert tides.find_peaks(np.array(x, float), prominence).tolist() == plain_peaks(x, prominence)


def test_tidal_report(spark):
    """Half-hourly steps, a datum offset, a face without peaks, one with highs alone, and intervals that are not accepted."""

    def at(t, hours=1.0):
        return datetime(2005, 1, 1) + timedelta(hours=t * hours)

    rows = [(f, t, at(t), math.cos(2 * math.pi * t / 12) * (1 + f)) for f in (0, 1) for t in range(60)]
    rows += [(2, t, at(t), t / 100) for t in range(60)]
    rows += [(3, t, at(t, 0.5), 5 + math.cos(2 * math.pi * t / 24)) for t in range(120)]
    rows += [(4, t, at(t), 1.0 if t == 20 else 0.001 * abs(t - 20)) for t in range(40)]
    rows += [(5, t, at(t), {6: 1.0, 18: 1.2, 42: 1.1, 58: 1.0}.get(t, 0.5 + 0.01 * (t % 2 == 0) - (0.3 if t in (12, 30) else 0))) for t in range(64)]
    rows += [(6, t, at(t, 0.5), None if t == 3 else math.cos(2 * math.pi * t / 49)) for t in range(200)]
    surface = spark.createDataFrame(rows, "face long, t long, time timestamp_ntz, zeta_center double")
    found = tides.peaks(surface)
    assert [r["t"] for r in found.where("face = 0 and is_high").orderBy("t").collect()] == [12, 24, 36, 48]
    both = {r["face"]: r for r in tides.surface_report(found).collect()}
    assert {r["face"]: r.asDict() for r in tides.tidal_levels(found).collect()} == {f: {k: v for k, v in r.asDict().items() if k in tides.tidal_levels(found).columns} for f, r in both.items()}
    assert abs(both[1]["max_high"] - 2) < 1e-9 and abs(both[1]["range_peaks"] - 4) < 1e-9
    mean = sum(t / 100 for t in range(60)) / 60  # no peaks: top and bottom fifth, over the mean
    assert both[2]["method"] == "top_share" and abs(both[2]["max_high"] - (0.59 - mean)) < 1e-9 and abs(both[2]["max_low"] - (0.11 - mean)) < 1e-9
    assert both[2]["type"] == "Unknown" and both[2]["mean_period"] == 0
    assert abs(both[3]["max_high"] - 1) < 1e-9 and abs(both[3]["msl_offset"] - 5) < 1e-9 and both[3]["mean_period"] == 12 and both[3]["type"] == "Twice Daily Tides"
    assert both[4]["method"] == "top_share" and both[4]["n_periods"] == 0 and both[4]["n_cycles"] == 0  # one high, no low: both sides from the shares
    assert both[0]["type"] == "Twice Daily Tides" and both[0]["n_periods"] == 3 and both[0]["mean_period"] == 12
    # Intervals of 12, 24 and 16 hours: two are accepted, their mean of 18 is neither kind; two have a low tide between.
    assert both[5]["n_periods"] == 2 and both[5]["mean_period"] == 18 and both[5]["type"] == "Mixed Pattern Tides"
    assert both[6]["type"] == "Once Daily Tides" and abs(both[6]["mean_period"] - 24.5) < 1e-9
    odd = {r["face"]: r["warnings"] for r in tides.level_warnings(tides.tidal_levels(found)).collect()}
    assert odd[3] == []  # the datum's offset is no fault


def test_ellipsoid_and_utm(spark):
    # One degree of latitude at 45 N is 111.13 km, one of longitude 78.85 km.
    r = one(spark, a=geo.ellipsoid_m(F.lit(44.95), F.lit(0.0), F.lit(45.05), F.lit(0.0)), b=geo.ellipsoid_m(F.lit(45.0), F.lit(179.95), F.lit(45.0), F.lit(-179.95)))
    assert abs(r["a"] - 11113.2) < 1.5 and abs(r["b"] - 7884.7) < 1.5
    lon, lat = geo.utm_to_lonlat(F.lit(500000.0), F.lit(0.0), 31)
    r = one(spark, lon=lon, lat=lat)
    assert abs(r["lon"] - 3) < 1e-9 and abs(r["lat"]) < 1e-9
    lon, lat = geo.utm_to_lonlat(F.lit(448251.8), F.lit(5411932.7), 31)  # Paris, Eiffel tower
    r = one(spark, lon=lon, lat=lat)
    assert abs(r["lon"] - 2.2945) < 1e-3 and abs(r["lat"] - 48.8582) < 1e-3


@pytest.mark.parametrize(("lon", "lat", "zone"), [(-152, 59, 5), (5, 60, 32), (10, 78, 33), (2, 50, 31), (179.9, 10, 60), (-180, 10, 1), (41, 80, 37)])
def test_utm_zone(spark, lon, lat, zone):
    assert one(spark, z=geo.utm_zone(F.lit(float(lon)), F.lit(float(lat))))["z"] == zone


def test_dateline_split(spark):
    def area(ring):
        return abs(sum(a["lon"] * b["lat"] - b["lon"] * a["lat"] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2

    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((179.5, 59.0), (-179.5, 59.0), (180.0, 60.0))))
    parts = one(spark, p=dateline.split_at_dateline(ring, 1e-6))["p"]
    assert len(parts) == 2 and abs(sum(map(area, parts)) - 0.5) < 1e-5
    assert all(p["lon"] > 0 for p in parts[0]) and all(p["lon"] < 0 for p in parts[1])
    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((10.0, 59.0), (11.0, 59.0), (10.5, 60.0))))
    assert len(one(spark, p=dateline.split_at_dateline(ring))["p"]) == 1


def test_polygons_with_concave_shape(spark):
    shape = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.5), (0.0, 4.0)]
    rng = random.Random(1)
    points = [(k, rng.uniform(-1, 5), rng.uniform(-1, 5)) for k in range(300)]
    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in shape))
    found = {r["qid"] for r in spatial.containing(spark.createDataFrame(points, "qid long, lat double, lon double"), spark.range(1).select(F.col("id").alias("pid"), ring.alias("ring"))).collect()}

    def inside(lat, lon):
        odd = False
        for (x1, y1), (x2, y2) in zip(shape, shape[1:] + shape[:1], strict=True):
            if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    assert found == {k for k, lat, lon in points if inside(lat, lon)}


def test_nearest_shore(spark):
    rng = random.Random(2)
    line = [(-152 + 0.1 * k, 59 + 0.05 * math.sin(k)) for k in range(12)]
    coast = spark.createDataFrame([(*a, *b) for a, b in itertools.pairwise(line)], "x1 double, y1 double, x2 double, y2 double")
    points = [(k, 59 + rng.uniform(-0.5, 0.5), -151.5 + rng.uniform(-0.5, 0.5)) for k in range(60)]
    got = {r["qid"]: r for r in tiles.nearest_shore(spark.createDataFrame(points, "qid long, lat double, lon double"), coast, snap_km=0.0).collect()}
    assert len(got) == 60
    for k, lat, lon in points:
        c = math.cos(math.radians(lat))
        best = math.inf
        for (x1, y1), (x2, y2) in itertools.pairwise(line):
            ax, bx, px = x1 * c, x2 * c, lon * c
            t = max(0, min(1, ((px - ax) * (bx - ax) + (lat - y1) * (y2 - y1)) / ((bx - ax) ** 2 + (y2 - y1) ** 2)))
            best = min(best, math.hypot(px - ax - t * (bx - ax), lat - y1 - t * (y2 - y1)))
        assert abs(got[k]["km"] - best * 111.195) < 0.2


def test_nearest_shore_however_far(spark):
    """Points of all oceans and a coast over the dateline; no point is lost, nor is a nearer shore outside a ring."""
    coast = [(-152.0, 59.0, -151.5, 59.2), (179.8, 51.0, -179.7, 51.4), (170.0, -44.0, 171.0, -43.0), (-5.0, 70.0, 5.0, 70.5)]
    rng = random.Random(6)
    points = [(k, rng.uniform(-75, 80), rng.uniform(-180, 180)) for k in range(60)] + [(60, 60.0, -148.0), (61, 62.5, -151.5), (62, 51.2, -179.0), (63, 51.2, 179.0)]
    p = spark.createDataFrame(points, "qid long, lat double, lon double")
    shore = spark.createDataFrame(coast, "x1 double, y1 double, x2 double, y2 double")
    got = {r["qid"]: r for r in tiles.nearest_shore(p, shore, snap_km=0.0).collect()}
    assert len(got) == len(points)
    for q, lat, lon in points:
        c, best, d = math.cos(math.radians(lat)), math.inf, math.inf
        for x1, y1, x2, y2 in coast:
            x2 += 360 if x2 - x1 < -180 else 0
            for turn in (-720, -360, 0, 360):
                ax, bx, px = (x1 + turn) * c, (x2 + turn) * c, lon * c
                t = max(0, min(1, ((px - ax) * (bx - ax) + (lat - y1) * (y2 - y1)) / ((bx - ax) ** 2 + (y2 - y1) ** 2)))
                best = min(best, math.hypot(px - ax - t * (bx - ax), lat - y1 - t * (y2 - y1)))
        r = got[q]
        d = math.hypot((abs(r["shore_lon"] - lon) if abs(r["shore_lon"] - lon) <= 180 else 360 - abs(r["shore_lon"] - lon)) * c, r["shore_lat"] - lat)
        assert abs(d - best) < 1e-6 and -180 <= r["shore_lon"] <= 180 and r["km"] > 0
    none = tiles.nearest_shore(p, shore.limit(0)).collect()
    assert len(none) == len(points) and all(r["km"] is None and r["shore_lat"] is None for r in none)


def test_nearest_is_brute_force(spark):
    rng = random.Random(3)
    points = [(k, 59 + rng.random() / 10, -152 + rng.random() / 10) for k in range(300)]
    queries = [(k, 59 + rng.random() / 10, -152 + rng.random() / 10) for k in range(40)]
    got = {r["qid"]: r["face"] for r in tiles.nearest(spark.createDataFrame(queries, "qid long, lat double, lon double"), spark.createDataFrame(points, "face long, lat double, lon double")).collect()}
    c = math.cos(math.radians(59.05))
    for q, lat, lon in queries:
        d = {p: math.hypot(y - lat, (x - lon) * c) for p, y, x in points}
        assert abs(d[got[q]] - min(d.values())) < 1e-5


def test_nearest_however_far(spark):
    """Queries far from all points, over the dateline and by the poles, against all pairs."""
    rng = random.Random(5)
    points = [(k, 59 + rng.random(), -152 + rng.random()) for k in range(40)] + [(40, 10.0, 179.999), (41, 10.02, -179.9), (42, 89.9, 10.0), (43, -30.0, 20.0), (44, -89.5, 0.0)]
    queries = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(40)] + [(40, 10.0, -179.999), (41, 89.95, -170.0), (42, 10.0, 179.95), (43, 59.5, -151.2), (44, 90.0, 0.0), (45, -89.9, 179.0)]
    p, q = spark.createDataFrame(points, "face long, lat double, lon double"), spark.createDataFrame(queries, "qid long, lat double, lon double")

    def km(a, b):
        (y1, x1), (y2, x2) = (map(math.radians, v) for v in (a, b))
        return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2)))

    def deg(a, b):
        east = abs(a[1] - b[1])
        return math.hypot(a[0] - b[0], min(east, 360 - east))

    got = {r["qid"]: r["km"] for r in tiles.nearest(q, p).collect()}
    assert got == {k: pytest.approx(min(km((y, x), (b, a)) for _, b, a in points), abs=1e-6) for k, y, x in queries}
    several = tiles.nearest_k(q, p, 3).groupBy("qid").agg(F.array_sort(F.collect_list("deg")).alias("deg")).collect()
    assert {r["qid"]: r["deg"] for r in several} == {k: pytest.approx(sorted(deg((y, x), (b, a)) for _, b, a in points)[:3], abs=1e-9) for k, y, x in queries}
    assert tiles.nearest_k(q, p, 50).count() == len(queries) * len(points)


def test_closed_lines(spark):
    arc = [(0.0, 0.0), (2.0, 0.5), (1.0, 0.2), (4.0, 0.0)]
    over = [(178.0, 50.0), (-179.0, 52.0), (-178.0, 51.0)]
    rows = [(1, arc), (2, over), (3, []), (4, None), (5, [(1.0, 1.0)])]
    lines = spark.createDataFrame(rows, "pid long, line array<struct<lon:double,lat:double>>")
    got = {r["pid"]: (r["crosses"], r["ring"] and [tuple(p) for p in r["ring"]]) for r in spatial.closed_lines(lines).collect()}
    assert got[1] == (False, [(0.0, 0.0), (4.0, 0.0), (2.0, 0.5)])
    assert got[2] == (True, [(-180.0, 48.0), (180.0, 48.0), (180.0, 54.0), (-180.0, 54.0)])
    assert got[3] == got[4] == (False, None) and got[5] == (False, [(1.0, 1.0)])
    feature = lines.where("pid in (1, 2)").selectExpr("pid", "case when pid = 1 then null else 'Alaska' end as region", "line", "false as closed")
    mended = {r["pid"]: (r["closed"], len(r["line"])) for r in spatial.repaired_boundaries(feature, "Alaska").collect()}
    assert mended == {1: (False, 4), 2: (True, 4)}


def test_transect_both_ways(spark):
    """A row of squares of two triangles, 0.01 degrees wide, crossed from its middle to both ends."""
    from saltmesh.plans import steps

    rows = []
    for k in range(10):
        x = k * 0.01
        rows += [(2 * k, x, 0.0, x + 0.01, 0.0, x, 0.01), (2 * k + 1, x + 0.01, 0.0, x + 0.01, 0.01, x, 0.01)]
    faces = spark.createDataFrame(rows, "face long, lon_1 double, lat_1 double, lon_2 double, lat_2 double, lon_3 double, lat_3 double")
    layers = spark.createDataFrame([(f, s, float(f)) for f in range(20) for s in (0, 1)], "face long, sigma_layer int, speed double")
    got = steps.transect_both_ways(faces, layers, 0.003, 0.0501, 90.0, 100.0).orderBy("along").collect()
    assert [r["face"] for r in got][::2] == list(range(20)) and len(got) == 40
    assert all(r["left_edge"] <= r["along"] <= r["right_edge"] and r["into"] <= r["along"] <= r["out_of"] for r in got)
    assert got[0]["along"] < 0 < got[-1]["along"]


def test_point_file_names(spark):
    r = one(spark, **names.parse_point_file(F.lit("cook_inlet.wave_2.face=00000012.lat=59.1234567.lon=-152.7654321-1h.parquet")))
    assert (r["location"], r["dataset"], r["face"], r["lat"], r["lon"], r["period"]) == ("cook_inlet", "wave_2", 12, 59.1234567, -152.7654321, "1h")
    assert set(one(spark, **names.parse_point_file(F.lit("other.txt"))).asDict().values()) == {None}


def test_range_text(spark):
    runs = time_checks.ranges(spark.createDataFrame([("a", i) for i in (1, 2, 3, 5, 7, 8, 9)], "k string, i long"), ["k"], "i")
    assert time_checks.range_text(runs, ["k"]).first()["indices"] == "1-3,5,7-9"


def test_assert_valid(spark):
    time_checks.assert_valid(spark.range(0))
    with pytest.raises(time_checks.InvalidData):
        time_checks.assert_valid(spark.range(2))


def test_nan_is_skipped(spark):
    rows = spark.createDataFrame([(0, float("nan")), (0, 1.0), (0, 3.0)], "face long, x double")
    out = summary.summary(rows.withColumn("x", derive.no_nan(F.col("x"))), "x", ["face"]).first()
    assert (out["n"], out["mean"], out["max"]) == (2, 2.0, 3.0)


def test_ledger_index_is_dense(spark, tmp_path):
    spark.range(50).repartition(7).write.parquet(f"{tmp_path}/data")
    rows = tables.ledger(tables.inventory(spark, f"{tmp_path}/data")).orderBy("file_index").collect()
    assert [r["file_index"] for r in rows] == list(range(len(rows))) and len(rows) == 7
    assert [r["relative_path"] for r in rows] == sorted(r["relative_path"] for r in rows)


def test_numbered_over_many_ranges(spark):
    """Ranges that are not joined to one: the places are those of the sorted list."""
    keys = [(k * 7919) % 100_003 for k in range(20_000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = tables.numbered(spark.createDataFrame([(k, "x") for k in keys], "k long, x string").repartition(9), ["k"])
        got = {r["k"]: r["position"] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {k: n for n, k in enumerate(sorted(keys))}


def test_read_precalculated(spark, tmp_path):
    faces = spark.createDataFrame([(1, 59.0, -152.0), (2, 60.0, -151.0)], "face long, lat double, lon double")
    whole = faces.select("face", F.col("lat").alias("latitude_center"), F.col("lon").alias("longitude_center"), F.lit(-9).alias("timezone_offset"), F.lit(1.0).alias("distance_to_shore"), F.lit("").alias("jurisdiction"), F.lit(0.0).alias("mean_navd88_offset"))
    whole.write.parquet(f"{tmp_path}/good")
    assert tables.read_precalculated(spark, f"{tmp_path}/good", faces).count() == 2
    whole.drop("jurisdiction").write.parquet(f"{tmp_path}/bare")
    with pytest.raises(time_checks.InvalidData, match="jurisdiction"):
        tables.read_precalculated(spark, f"{tmp_path}/bare", faces)
    whole.withColumn("latitude_center", F.col("latitude_center") + 0.1).write.parquet(f"{tmp_path}/off")
    with pytest.raises(time_checks.InvalidData, match="latitude"):
        tables.read_precalculated(spark, f"{tmp_path}/off", faces)


def test_append_missing_adds_nothing_twice(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("time"), (F.col("id") % 4).alias("day"))
    for part in (rows.where("day < 2"), rows, rows):
        tables.append_missing(part, f"{tmp_path}/grown", ["day"])
    assert sorted(r["time"] for r in spark.read.parquet(f"{tmp_path}/grown").collect()) == list(range(40))


def test_running_summary_takes_new_files_once(spark, tmp_path):
    schema = "face long, x double"
    args = (spark, f"{tmp_path}/in", schema, f"{tmp_path}/state", f"{tmp_path}/check", "x")
    spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0)], schema).write.parquet(f"{tmp_path}/in/a")
    spark.createDataFrame([(1, 9.0)], schema).write.parquet(f"{tmp_path}/in/b")
    args = (spark, f"{tmp_path}/in/*", *args[2:])
    first = {r["face"]: r["n"] for r in running_summary.run(*args).collect()}
    assert first == {1: 3, 2: 1}
    spark.createDataFrame([(2, 7.0)], schema).write.parquet(f"{tmp_path}/in/c")
    second = {r["face"]: (r["n"], r["high"]) for r in running_summary.summary_of(running_summary.run(*args)).collect()}
    assert second == {1: (3, 9.0), 2: (2, 7.0)}
