"""Operators that hold no whole group: selection, coverings, rings, hulls, hotspots, profiles and the manifest, against plain restatements."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmesh.operators import cover, hotspots, manifest, precalc, profiles, records, rings, selection, spatial, summary, tides, tiles
from saltmesh.operators.time_checks import InvalidData
from saltmesh.plans import steps
from saltmesh.sources import layout
from saltmesh.streaming import running_summary


@pytest.mark.parametrize("few", [200_000, 0])
def test_percentiles(spark, monkeypatch, few):
    """Hot values, heavy tails, small groups, nulls and NaN; with and without ranges. A bracket holds a small part of a large group."""
    monkeypatch.setattr(selection, "FEW_VALUES", few)
    rng = np.random.default_rng(3)
    groups = {
        "even": rng.random(30_000), "tail": 10 ** rng.uniform(-200, 200, 30_000), "hot": np.where(rng.random(30_000) < 0.6, 5.0, rng.normal(5, 1e-3, 30_000)),
        "same": np.full(20_000, -1.5), "small": rng.normal(0, 1, 7), "one": np.array([2.0]), None: rng.integers(0, 4, 12_345).astype(float),
    }
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("small", None), ("small", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    shares = [0.0, 0.05, 0.5, 0.95, 0.9999, 1.0]
    got = {r["g"]: r for r in selection.percentiles(df, ["g"], "x", shares, {"n": F.count("x"), "hi": F.max("x")}, accuracy=1000).collect()}
    assert set(got) == {*groups, "none"} and got["none"]["q"] is None and got["none"]["n"] == 0
    for k, v in groups.items():
        assert np.allclose(got[k]["q"], np.quantile(v, shares), rtol=1e-12, atol=0) and (got[k]["n"], got[k]["hi"]) == (len(v), v.max())
    whole = selection.percentiles(df, [], "x", [0.5, 0.99], accuracy=1000).collect()
    assert len(whole) == 1 and np.allclose(whole[0]["q"], np.quantile(np.concatenate(list(groups.values())), [0.5, 0.99]), rtol=1e-12)
    assert selection.percentiles(df.limit(0), [], "x", [0.5]).collect()[0]["q"] is None
    assert selection.percentiles(df.limit(0), ["g"], "x", [0.5]).count() == 0
    assert summary.basic_statistics(df.where("g = 'one'"), "x", []).collect()[0].asDict() == {"min": 2.0, "max": 2.0, "mean": 2.0, "std": 0.0, "median": 2.0, "p95": 2.0, "p99": 2.0}


def inside(rings_, lat, lon):
    odd = False
    for ring in rings_:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def polygons_for_cover():
    rng = random.Random(5)
    star = [(-150 + (0.3 + 0.7 * rng.random()) * math.cos(a), 59 + (0.3 + 0.7 * rng.random()) * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 1500, endpoint=False)]
    hole = [(-150 + 0.1 * math.cos(a), 59 + 0.1 * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 60, endpoint=False)]
    comb = [p for k in range(80) for p in ((-151 + k / 80, 58.0), (-151 + k / 80, 60.0), (-151 + (k + 0.5) / 80, 60.0), (-151 + (k + 0.5) / 80, 58.0))]
    grid = [(-151.0, 58.0), (-150.5, 58.5), (-150.0, 58.0), (-149.5, 58.5), (-149.0, 58.0), (-149.0, 60.0), (-151.0, 60.0), (-151.0, 58.0)]
    needle = [(-150.0, 59.0), (-150.0, 59.0 + 1e-9), (-149.0, 59.5)]
    fan = [p for k in range(40) for p in ((-150.25, 59.25), (-151 + k / 40, 58.2), (-151 + (k + 0.4) / 40, 58.2))]
    return [(1, star), (1, hole), (2, comb), (3, grid), (4, needle), (5, fan), (6, []), (7, [(1.0, 1.0)]), (8, [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)])]


@pytest.mark.parametrize("leaf,finest", [(16, 20), (2, 12)])
def test_containing(spark, leaf, finest):
    """Thousands of edges, holes, vertical and level edges, corners on the borders of cells, a fan through one place."""
    shapes = polygons_for_cover()
    rng = random.Random(6)
    places = [(rng.uniform(57.9, 60.1), rng.uniform(-151.2, -148.8)) for _ in range(1200)]
    places += [(y, x) for _, ring in shapes for x, y in ring[:40]]  # corners
    side = 360 / 2**12
    places += [(-180 + round((180 + y) / side) * side, -180 + round((180 + x) / side) * side) for y, x in places[:200]]
    points = [(k, y, x) for k, (y, x) in enumerate(places)] + [(9000, None, 1.0), (9001, float("nan"), 1.0)]
    df = spark.createDataFrame(shapes, "pid long, ring array<struct<lon:double,lat:double>>")
    at = spark.createDataFrame(points, "qid long, lat double, lon double")
    got = {(r["qid"], r["pid"]) for r in cover.containing(at, df, leaf, finest).collect()}
    assert got == {(k, pid) for k, y, x in points[:-2] for pid in range(1, 9) if inside([r for i, r in shapes if i == pid], y, x)}


@pytest.mark.parametrize("leaf", [16, 1])
def test_points_on_edges_are_decided_by_a_condition(spark, leaf):
    """Of a square with a hole, on_edge decides on the points of its edges alone; columns of its rows don't multiply them."""
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    square = spark.createDataFrame([(1, ring(10.0, 14.0), True), (1, ring(11.0, 13.0), True), (2, ring(10.0, 14.0), False)], "pid long, ring array<struct<lon:double,lat:double>>, closed boolean")
    on = [(10.0, 12.0), (14.0, 12.0), (12.0, 10.0), (12.0, 14.0), (10.0, 10.0), (14.0, 14.0)]
    hole, inside, outside = [(11.0, 12.0), (12.0, 13.0)], [(10.5, 12.0), (10.0 + 1e-9, 12.0)], [(9.5, 12.0), (10.0 - 1e-9, 12.0)]
    at = [*on, *hole, *inside, *outside, (12.0, 12.0)]
    points = spark.createDataFrame([(k, y, x) for k, (x, y) in enumerate(at)], "qid long, lat double, lon double")
    got = sorted((r["pid"], r["qid"]) for r in cover.containing(points, square, leaf, on_edge=F.col("closed")).collect())
    assert got == [(1, k) for k in range(10)] + [(2, k) for k in (6, 7, 8, 9, 12)]


def test_covering_is_bounded(spark):
    """A circle of many edges: cells within need no edge, cells of the boundary hold few, and cells follow the boundary."""
    ring = [(math.cos(a), math.sin(a)) for a in np.linspace(0, 2 * math.pi, 4000, endpoint=False)]
    df = spark.createDataFrame([(1, ring)], "pid long, ring array<struct<lon:double,lat:double>>")
    cells = cover.covering(df).select(F.size("edges").alias("n"), "level").toPandas()
    assert cells["n"].max() <= cover.LEAF and (cells["n"] == 0).sum() > 50 and len(cells) < 4000
    areas = (360 / 2.0 ** cells["level"]) ** 2
    assert areas[cells["n"] == 0].sum() > 0.9 * math.pi


def walked(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    out, ring = [], 0
    for start in sorted(near):
        node, pos = start, 0
        while near[node]:
            out.append((ring, pos, node))
            following = min(near[node])
            near[node].remove(following)
            near[following].remove(node)
            node, pos = following, pos + 1
        ring += pos > 0
    return out


def test_ring_of_edges(spark):
    """A long ring of shuffled node numbers and short ones beside it; repeated edges; rings that touch use every edge once."""
    rng = random.Random(7)
    edges = []
    for first, n in ((0, 20_000), (30_000, 3), (40_000, 4), (50_000, 101)):
        nodes = list(range(first, first + n))
        rng.shuffle(nodes)
        edges += [(a, b) if rng.random() < 0.5 else (b, a) for a, b in zip(nodes, nodes[1:] + nodes[:1], strict=True)]
    df = spark.createDataFrame([("s", *e) for e in edges + edges[:50]], "location string, a long, b long").repartition(4)
    got = sorted((r["ring"], r["pos"], r["node"]) for r in rings.ring_of_edges(df).collect())
    assert got == walked(edges)
    eight = [(1, 2), (2, 3), (3, 1), (1, 4), (4, 5), (5, 1)]
    found = rings.ring_of_edges(spark.createDataFrame([("e", *e) for e in eight], "location string, a long, b long")).orderBy("ring", "pos").collect()
    turns = [(r["ring"], r["node"]) for r in found]
    used = sorted(tuple(sorted((a, b))) for ring in {r for r, _ in turns} for own in [[n for r, n in turns if r == ring]] for a, b in zip(own, own[1:] + own[:1], strict=True))
    assert used == sorted(tuple(sorted(e)) for e in eight)
    with pytest.raises(InvalidData):
        rings.ring_of_edges(spark.createDataFrame([("s", 1, 2), ("s", 2, 3)], "location string, a long, b long"))
    assert rings.ring_of_edges(df.limit(0)).count() == 0


def test_convex_hull(spark, monkeypatch):
    monkeypatch.setattr(rings, "HELD", 500)
    rng = np.random.default_rng(2)
    sets = {0: [(float(x), float(y)) for x in range(4) for y in range(4)], 1: list(map(tuple, rng.normal(0, 1, (20_000, 2)).tolist())), 2: [(math.cos(a), math.sin(a)) for a in np.linspace(0, 6, 800)], 3: [(1.0, 1.0)] * 5, None: [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]}
    rows = [(k, x, y) for k, v in sets.items() for x, y in v] + [(0, None, 1.0), (0, float("nan"), 9.0)]
    got = rings.convex_hull(spark.createDataFrame(rows, "k long, lon double, lat double").repartition(5), "k").orderBy("pos").collect()
    for k, v in sets.items():
        assert [(r["lon"], r["lat"]) for r in got if r["k"] == k] == rings._hull(v)
    assert [(r["lon"], r["lat"]) for r in got if r["k"] == 0] == [(0, 0), (3, 0), (3, 3), (0, 3)]


def metres(a, b):
    y1, x1, y2, x2 = map(math.radians, (a[1], a[2], b[1], b[2]))
    return 2 * 6371000 * math.asin(math.sqrt(math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2))


def greedy(cells, spacing, top, area):
    """The plain loop over all cells in order, with the set of cells that areas have taken."""
    half, order, taken, found, now = math.sqrt(area) / 111_000 / 2, sorted(cells, key=lambda c: (-c[3], c[0])), set(), [], spacing
    while True:
        for c in order:
            if len(found) >= top:
                break
            if c[0] in taken or any(metres(c, f[0]) < now for f in found):
                continue
            own = [c]
            for o in order:
                if o is not c and o[0] not in taken and abs(o[1] - c[1]) <= half and abs(o[2] - c[2]) <= half:
                    own.append(o)
                    taken.add(o[0])
            found.append((c, own))
        if len(found) >= top or now <= spacing * 0.3:
            return found
        now *= 0.8


@pytest.mark.parametrize("spacing,top,area,candidates", [(300.0, 8, 1e6, 10_000), (1500.0, 6, 1e4, 7), (30.0, 5, 1e4, 3), (4000.0, 9, 4e6, 10_000), (50.0, 40, 250_000.0, 10)])
def test_hotspots(spark, spacing, top, area, candidates):
    rng = random.Random(8)
    cells = [(k, 59 + rng.random() * 0.03, -152 + rng.random() * 0.03, float(rng.randint(1, 20))) for k in range(150)] + [(200 + k, 59.1 + k * 1e-4, -152.0, 30.0 - k) for k in range(40)]
    df = spark.createDataFrame([*cells, (900, 59.0, -152.0, None), (901, 59.0, -152.0, float("nan"))], "face long, lat double, lon double, power double")
    got = hotspots.hotspots(df, spacing, top, area, candidates).orderBy("rank").collect()
    want = greedy(cells, spacing, top, area)
    assert [r["face"] for r in got] == [c[0] for c, _ in want] and len(got) > 1
    for r, (c, own) in zip(got, want, strict=True):
        assert r["n"] == len(own) and math.isclose(r["total"], sum(o[3] for o in own)) and math.isclose(r["mean"], sum(o[3] for o in own) / len(own))
        assert math.isclose(r["nearest_m"], min(metres(c, o) for o, _ in want if o is not c), rel_tol=1e-9)
    assert hotspots.hotspots(df.limit(0), spacing, top, area).count() == 0


def test_profile_of_a_plane(spark):
    """Values that are linear in place are met exactly between the centres of an irregular mesh, and nowhere else."""
    rng = random.Random(9)
    nodes = [(6 * j + i, 0.1 * i + rng.uniform(-0.02, 0.02), 0.1 * j + rng.uniform(-0.02, 0.02)) for j in range(6) for i in range(6)]
    at = {n: (x, y) for n, x, y in nodes}
    corners = [t for j in range(5) for i in range(5) for a in [6 * j + i] for t in ((a, a + 1, a + 6), (a + 1, a + 7, a + 6))]
    faces = [(f, *t, sum(at[n][1] for n in t) / 3, sum(at[n][0] for n in t) / 3) for f, t in enumerate(corners)]
    plane = lambda x, y: 3 + 2 * x - 5 * y
    triangles = profiles.dual_triangles(spark.createDataFrame(faces, "face long, n1 long, n2 long, n3 long, lat double, lon double"), spark.createDataFrame(nodes, "node long, lon_node double, lat_node double"))
    values = spark.createDataFrame([(f, plane(x, y)) for f, _, _, _, y, x in faces], "face long, v double")
    lines = spark.createDataFrame([(1, 0.02, -0.2, 0.45, 0.6), (2, 0.25, 0.1, 0.25, 0.4)], "line long, lat1 double, lon1 double, lat2 double, lon2 double")
    got = profiles.profile(lines, 41, triangles, values, ["v"]).orderBy("line", "i").collect()
    assert len(got) == 82 and [r["v"] is None for r in got if r["line"] == 2] == [False] * 41
    assert all(r["v"] is None or math.isclose(r["v"], plane(r["lon"], r["lat"]), abs_tol=1e-9) for r in got)
    assert 10 < sum(r["v"] is None for r in got) < 41
    one = [r for r in got if r["line"] == 1]
    way = 0.0
    for a, b in zip(one, one[1:], strict=False):
        way += metres((0, a["lat"], a["lon"]), (0, b["lat"], b["lon"])) / 1000
        assert math.isclose(b["km"], way, rel_tol=1e-9)


def test_manifest_writes_what_changed(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    points = [(f"s{k % 2}", k, 59 + (k % 10) * 0.01 + 0.005, -152 + (k // 10) * 0.001) for k in range(200)]
    df = lambda rows: spark.createDataFrame(rows, "location string, face long, lat double, lon double")
    written = lambda v: sorted({json.loads(x)["cy"] for p in (tmp_path / "manifest" / "grids" / f"written={v}").rglob("*.json") for x in p.read_text().splitlines()})
    assert manifest.latest(spark, folder) is None
    assert manifest.build(df(points[:150]), folder, "tidal", "1h", "1.0.0", "2024-01-01") == "1.0.0"
    assert manifest.build(df(points[:150][::-1]).repartition(3), folder, "tidal", "1h", "1.0.0", "2024-01-01") == "1.0.0"
    more = points[:150] + [("s1", 500, 59.035, -151.999)]
    assert manifest.build(df(more), folder, "tidal", "1h", "1.0.0", "2024-01-01") == "1.0.1"
    assert written("1.0.1") == [5903] and len(written("1.0.0")) == 10
    fewer = [p for p in more if p[2] > 59.01]
    assert manifest.build(df(fewer), folder, "tidal", "1h", "1.0.0", "2024-01-01") == "1.0.2"
    assert not (tmp_path / "manifest" / "grids" / "written=1.0.2").exists() or written("1.0.2") == []
    for version, rows in (("1.0.0", points[:150]), ("1.0.1", more), ("1.0.2", fewer)):
        held = manifest.details(spark, folder, version).collect()
        assert sorted((r["location"], r["face"], r["lat"], r["lon"]) for r in held) == sorted(rows)
        assert sum(r["n_points"] for r in manifest.cells(spark, folder, version).collect()) == len(rows)
        assert sum(r["n_points"] for r in manifest.locations(spark, folder, version).collect()) == len(rows)
    # A new data version changes all paths; a build that broke off before its last write isn't seen, and is done again.
    assert manifest.build(df(fewer), folder, "tidal", "1h", "1.1.0", "2025-01-01") == "1.0.3"
    assert sorted((r["location"], r["version"], r["date"]) for r in manifest.history(spark, folder).collect()) == [(s, v, d) for s in ("s0", "s1") for v, d in (("1.0.0", "2024-01-01"), ("1.1.0", "2025-01-01"))]
    last = tmp_path / "manifest" / "versions" / "manifest_version=1.0.3"
    for p in last.iterdir():
        p.unlink()
    last.rmdir()
    assert manifest.latest(spark, folder) == "1.0.2" and "/v1.0.0/" in manifest.details(spark, folder).first()["path"]
    assert manifest.build(df(fewer), folder, "tidal", "1h", "1.1.0", "2025-01-01") == "1.0.3"
    assert manifest.details(spark, folder).where("path like '%/v1.1.0/%'").count() == len(fewer)


def test_closed_lines_use_partial_hulls(spark):
    lines = spark.createDataFrame([(1, [(0.0, 0.0), (2.0, 0.5), (1.0, 0.2), (4.0, 0.0)])], "pid long, line array<struct<lon:double,lat:double>>")
    assert [tuple(p) for p in spatial.closed_lines(lines).collect()[0]["ring"]] == [(0.0, 0.0), (4.0, 0.0), (2.0, 0.5)]


def test_far_queries_open_few_leaves(spark):
    """Queries far from one dense cluster, and inside of it; places that repeat a thousand times."""
    rng = np.random.default_rng(1)
    n = 60_000
    at = np.round(rng.normal([59.0, -152.0], 0.01, (n, 2)), 7)
    at[:2000] = at[0]
    points = spark.createDataFrame([(k, float(y), float(x)) for k, (y, x) in enumerate(at)], "face long, lat double, lon double").repartition(4)
    asked = [(k, float(y), float(x)) for k, (y, x) in enumerate(np.vstack([rng.uniform([-80, -180], [80, 180], (150, 2)), at[[0, 9, 5000]], rng.normal([59.0, -152.0], 0.01, (50, 2))]))]
    queries = spark.createDataFrame(asked, "qid long, lat double, lon double")
    found = tiles.tiles_of_points(points, 1)
    assert len(found.levels) == 2 and found.levels[0].agg(F.max("n")).first()[0] <= tiles.LEAF
    places = queries.select("qid", F.col("lat").alias("qlat"), F.col("lon").alias("qlon"))
    opened = tiles.candidates(places, found, 1, tiles.reach_km).groupBy("qid").count().toPandas()["count"]
    assert len(opened) == len(asked) and opened.mean() < 2 * math.sqrt(found.sizes[0]) and opened.max() < found.sizes[0] / 3
    got = {r["qid"]: (r["face"], r["km"]) for r in tiles.nearest(queries, points).collect()}
    three = {}
    for r in tiles.nearest_k(queries, points, 3).orderBy("qid", "rank").collect():
        three.setdefault(r["qid"], []).append((r["face"], r["deg"]))
    y, x = np.radians(at[:, 0]), np.radians(at[:, 1])
    for k, qy, qx in asked:
        a, b = math.radians(qy), math.radians(qx)
        km = 2 * 6371 * np.arcsin(np.sqrt(np.minimum(1, np.sin((y - a) / 2) ** 2 + np.cos(a) * np.cos(y) * np.sin((x - b) / 2) ** 2)))
        east = np.abs(at[:, 1] - qx)
        deg = np.sqrt((at[:, 0] - qy) ** 2 + np.where(east > 180, 360 - east, east) ** 2)
        assert math.isclose(got[k][1], km.min(), abs_tol=1e-6) and km[got[k][0]] <= km.min() + 1e-6
        assert np.allclose([d for _, d in three[k]], np.sort(deg)[:3], atol=1e-9)
    assert got[150][0] == 0 and [f for f, _ in three[150]] == [0, 1, 2]
    assert tiles.nearest(queries, points.limit(0)).count() == tiles.nearest(queries.limit(0), points).count() == 0


@pytest.mark.parametrize("met", [65_536, 2_000])
def test_long_segments_open_few_leaves(spark, monkeypatch, met):
    """Segments as long as the area that they cross: their pieces have tight boxes, and each point still finds the nearest place of whole segments, in one group or in several."""
    monkeypatch.setattr(tiles, "MET", met, raising=False)
    rng = np.random.default_rng(4)
    ends = rng.uniform([-153.0, 59.0, -153.0, 59.0], [-152.0, 60.0, -152.0, 60.0], (2000, 4))
    ends = np.vstack([ends, [[-152.5, 59.5, -152.5, 59.5], [179.5, 59.0, -179.5, 60.0]]])
    form = "x1 double, y1 double, x2 double, y2 double"
    coast = spark.createDataFrame([tuple(map(float, e)) for e in ends], form)
    wide = tiles.tiles_of_segments(coast).levels[0].where("pmod(lon1, 360D) > 200").agg(F.avg(F.col("lon2") - F.col("lon1")), F.avg(F.col("lat2") - F.col("lat1"))).first()
    assert max(wide) < 0.4
    coast = coast.unionByName(spark.createDataFrame([(None, 1.0, 2.0, 3.0), (float("nan"), 1.0, 2.0, 3.0)], form))
    at = np.vstack([rng.uniform([59.0, -153.0], [60.0, -152.0], (300, 2)), ends[:20, [1, 0]], [[59.5, -152.5], [59.5, 179.9], [59.4, -179.9], [70.0, 20.0]]])
    rows = [(k, float(y), float(x)) for k, (y, x) in enumerate(at)]
    points = spark.createDataFrame([*rows, rows[0], (len(rows), None, 1.0)], "qid long, lat double, lon double").repartition(4)
    got = tiles.nearest_shore(points, coast, snap_km=0.0).collect()
    assert len(got) == len(rows) + 2 and sum(r["qid"] == 0 for r in got) == 2 and [r["qid"] for r in got if r["km"] is None] == [len(rows)]
    x1, y1, y2 = ends[:, 0], ends[:, 1], ends[:, 3]
    dx, dy = (ends[:, 2] - x1 + 180) % 360 - 180, y2 - y1
    for r in got:
        if r["qid"] == len(rows):
            continue
        lat, lon = at[r["qid"]]
        k, best = math.cos(math.radians(lat)), math.inf
        for turn in (-360, 0, 360):
            ax, ay = (x1 + turn - lon) * k, y1 - lat
            t = np.clip(-(ax * dx * k + ay * dy) / np.maximum((dx * k) ** 2 + dy**2, 1e-30), 0, 1)
            best = min(best, np.hypot(ax + t * dx * k, ay + t * dy).min())
        east = abs(r["shore_lon"] - lon)
        assert math.isclose(math.hypot(min(east, 360 - east) * k, r["shore_lat"] - lat), best, abs_tol=1e-9)


def test_lines_mark_cells_along_them(spark):
    """A long slanted line marks cells by its length, not by its box; steep, level, short and pointlike ones are whole too."""
    lines = [(1, 50.0, -160.0, 58.0, -150.0), (2, 59.0, -150.0, 60.0, -150.0), (3, 59.0, -150.0, 59.0, -149.0), (4, 59.001, -150.0, 59.0011, -149.9999), (5, 59.0, -150.0, 59.0, -150.0), (6, 59.0, -149.9, 59.02, -149.0)]
    df = spark.createDataFrame(lines, "sid long, lat1 double, lon1 double, lat2 double, lon2 double")
    most = 0.0213
    marked = {}
    for r in tiles.lines_cells(df, most).select("sid", "cy", "cx").collect():
        marked.setdefault(r["sid"], []).append((r["cy"], r["cx"]))
    assert all(len(set(v)) == len(v) for v in marked.values())
    assert len(marked[1]) < 20 * 1300
    for sid, y1, x1, y2, x2 in lines[1:]:
        cy, cx = np.meshgrid(np.arange(int(y1 * 100) - 20, int(y2 * 100) + 20), np.arange(int(x1 * 100) - 20, int(x2 * 100) + 20))
        py, px, dy, dx = cy / 100 + 0.005, cx / 100 + 0.005, y2 - y1, x2 - x1
        w = np.clip(((px - x1) * dx + (py - y1) * dy) / max(dx * dx + dy * dy, 1e-30), 0, 1)
        near = np.hypot(px - x1 - w * dx, py - y1 - w * dy) <= most
        assert set(zip(cy[near].tolist(), cx[near].tolist(), strict=True)) <= set(marked[sid])


def test_closest_cells_are_tied_at_six_places(spark):
    """Cells on both sides of a line between two columns are as far from it but for rounding: the smaller comes first."""
    cells = spatial.grid_index(spark.createDataFrame([(k, 59.005 + k // 6 / 100, -151.045 + k % 6 / 100) for k in range(120)], "face long, lat double, lon double"))
    lines = spark.createDataFrame([(k, 59.005 + k / 100, -151.02, 59.145 + k / 1000, -151.02) for k in range(8)], "sid long, lat1 double, lon1 double, lat2 double, lon2 double")
    rows = spatial.along_segments(cells, lines, 0.0213).select("sid", "cy", "cx", "off").collect()
    got = spatial.along_segments(cells, lines, 0.0213, 5).select("sid", "cy", "cx").collect()
    for sid in range(8):
        own = sorted((round(r["off"], 6), r["cy"], r["cx"]) for r in rows if r["sid"] == sid)
        assert sorted((r["cy"], r["cx"]) for r in got if r["sid"] == sid) == sorted(r[1:] for r in own[:5])


def test_marked_cells_are_not_broadcast(spark, monkeypatch):
    """The table of segments is small by its estimate, and marks many cells: the counted cells are sent around, or both sides are shuffled."""
    cells = spatial.grid_index(spark.range(20_000).select(F.col("id").alias("face"), (59 + F.col("id") % 100 / 100 + 0.005).alias("lat"), (-152 + F.floor(F.col("id") / 100) / 100 + 0.005).alias("lon")))
    segments = spark.range(40).select(F.col("id").alias("sid"), (59 + F.col("id") / 50).alias("lat1"), F.lit(-152.0).alias("lon1"), F.lit(59.5).alias("lat2"), F.lit(-151.0).alias("lon2"))
    found = spatial.along_segments(cells, segments, 0.0213).select("sid", "cy", "cx")
    assert "BuildLeft" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "BuildRight" in plan
    monkeypatch.setattr(spatial, "broadcast_if_few", lambda df: df)
    spread = spatial.along_segments(cells, segments, 0.0213).select("sid", "cy", "cx")
    assert "BroadcastHashJoin" not in spread._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.collect()) == sorted(spread.collect())


def test_precalculated_computes_what_is_missing(spark):
    faces = spark.createDataFrame([(k, 59.0 + k, -150.0) for k in range(4)], "face long, lat double, lon double")
    calls = []

    def maker(name, value):
        def make(table):
            calls.append(name)
            return table.select("face", value.alias(name))

        return make

    makers = {"zone": maker("zone", F.lit(-9)), "shore": maker("shore", F.col("lat") * 2), "kind": maker("kind", F.when(F.col("face") > 1, F.lit("a")).otherwise("b")), "size": maker("size", F.col("face") * 1.5)}
    needs = {"kind": ("shore",)}
    whole, computed = precalc.precalculated(faces, makers, needs)
    assert computed == calls == ["zone", "shore", "kind", "size"]

    def again(existing, want, stale=()):
        calls.clear()
        table, computed = precalc.precalculated(faces, makers, needs, existing, stale)
        assert computed == calls == want
        return {r["face"]: r for r in table.collect()}

    again(whole, [])
    kept = again(whole.drop("size").withColumn("zone", F.lit(7)), ["size"])
    assert [kept[k]["zone"] for k in range(4)] == [7] * 4 and kept[3]["size"] == 4.5
    again(whole.withColumn("shore", F.when(F.col("face") != 2, F.col("shore"))), ["shore", "kind"])
    again(whole, ["shore", "kind"], stale=["shore"])
    again(whole, ["kind"], stale=["kind"])
    every = ["zone", "shore", "kind", "size"]
    again(whole.where("face <> 3"), every)
    again(whole.unionByName(whole.limit(1)), every)
    again(whole.withColumn("lat", F.col("lat") + 0.01), every)
    again(None, every)
    with pytest.raises(InvalidData):
        precalc.precalculated(faces, {"kind": makers["kind"], "shore": makers["shore"]}, needs)


def test_running_summary_survives_a_killed_batch(spark, tmp_path):
    """States are whole or not there; a batch that runs again adds nothing twice; one state and the one before it stay."""
    state = str(tmp_path / "state")
    rng = np.random.default_rng(4)
    batches = [[(int(f), float(x)) for f, x in zip(rng.integers(0, 3, 500), rng.normal(f0, 1, 500), strict=True)] for f0 in range(6)]
    df = lambda rows: spark.createDataFrame(rows, "face long, speed double")
    for n in range(4):
        running_summary.add_batch(df(batches[n]), n, state, "speed")
    assert running_summary.versions(spark, state) == [2, 3]
    (tmp_path / "state" / "upto=3" / "_SUCCESS").unlink()  # as if batch 3 had been killed while it wrote
    assert running_summary.versions(spark, state) == [2]
    running_summary.add_batch(df(batches[3]), 3, state, "speed")
    running_summary.add_batch(df(batches[4]), 4, state, "speed")
    running_summary.add_batch(df(batches[4]), 4, state, "speed")
    running_summary.add_batch(df([*batches[5], (0, None), (0, float("nan")), (9, None)]), 5, state, "speed")
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("upto=")]) == 2
    got = {r["face"]: r for r in running_summary.summary_of(running_summary.read_state(spark, state, f"face long, {running_summary.STATE}")).collect()}
    assert (got[9]["n"], got[9]["mean"], got[9]["p50"]) == (0, None, None)
    for face in range(3):
        x = np.sort([v for b in batches for f, v in b if f == face])
        r = got[face]
        assert r["n"] == len(x) and math.isclose(r["mean"], x.mean(), rel_tol=1e-9) and (r["high"], r["low"]) == (x.max(), x.min())
        assert all(abs(np.searchsorted(x, r[f"p{round(q * 100)}"]) / len(x) - q) < 0.02 for q in (0.5, 0.95, 0.99))


def test_lookup_of_a_version(spark):
    df = spark.createDataFrame
    points = df([("a", 1, 59.0, -150.0), ("a", 2, 59.01, -150.0), ("b", 3, 61.0, -150.0)], "location string, face long, lat double, lon double")
    queries = df([(1, 59.0001, -150.0), (2, 59.0099, -150.0), (3, 61.0, -150.0), (4, 70.0, -150.0)], "qid long, lat double, lon double")
    versions = df([("a", "1.2.0"), ("a", "1.10.0"), ("b", "1.2.0")], "location string, version string")
    series = df([(f, t, f * 1.0 + t) for f in (1, 3) for t in range(3)], "face long, t long, u double")
    got = steps.lookup(queries, points, versions, series, 500.0).collect()
    assert sorted((r["qid"], r["version"], r["n_versions"], r["t"]) for r in got if r["t"] is not None) == [(1, "1.10.0", 2, 0), (1, "1.10.0", 2, 1), (1, "1.10.0", 2, 2), (3, "1.2.0", 1, 0), (3, "1.2.0", 1, 1), (3, "1.2.0", 1, 2)]
    assert [(r["qid"], r["u"]) for r in got if r["t"] is None] == [(2, None)]  # a point without a series
    old = steps.lookup(queries, points, versions, series, 500.0, version="1.10.0").collect()
    assert {r["qid"] for r in old} == {1, 2} and all("/v1.10.0/" in r["path"] for r in old)


def test_export_of_a_broken_chunk(spark):
    rows = spark.createDataFrame([(0, t, s, 1.0, None if t == 5 else 2.0) for t in range(8) for s in (0, 1)], "face long, t long, sigma_layer long, u double, v double").withColumn("time", F.timestamp_seconds("t").cast("timestamp_ntz"))
    expected = rows.select("face", "time").distinct().unionByName(spark.createDataFrame([(0,)], "face long").withColumn("time", F.lit("2005-01-01 00:00:00").cast("timestamp_ntz")))
    whole = steps.exported(rows, expected, ["u", "v"], [0, 1], F.floor(F.col("t") / 4))
    found = {r["time_index"]: r for r in whole.collect()}
    assert len(found) == 9 and found["2005-01-01 00:00:00+00:00"]["u_sigma_layer_00"] == -999.0 == found["1970-01-01 00:00:05+00:00"]["v_sigma_layer_01"]
    with pytest.raises(InvalidData):
        steps.exported(rows, expected, ["u", "v"], [0, 1], F.col("t"))


def test_regions_of_all_variables(spark):
    rows = [(g, float(x), float(x * x)) for g in ("a", "b", None) for x in range(50)] + [("c", None, 1.0)]
    got = {(r["region"], r["variable"]): r for r in steps.regions(spark.createDataFrame(rows, "region string, x double, y double"), "region", {"x": 10, "y": 1e9}).collect()}
    assert set(got) == {(g, v) for g in ("a", "b", "c", None) for v in "xy"}
    assert got[None, "x"]["n"] == 150 and got["c", "x"]["p95"] is None and got["a", "x"]["kept_percent"] == 22.0
    assert math.isclose(got["b", "y"]["p95"], np.quantile(np.arange(50) ** 2, 0.95))


def test_verified_tracks_only_clean_sites(spark):
    axis = spark.createDataFrame([(0, p) for p in range(4)], "file long, pos long").withColumn("time", F.timestamp_seconds(F.col("pos") * 3600).cast("timestamp_ntz"))
    spec = axis.groupBy("file").agg(F.min("time").alias("start"), F.max("time").alias("end")).withColumn("step", F.lit(3600.0))
    assert steps.tracking(axis, steps.verified(axis, spec, 3600.0)).count() == 4
    places = spark.createDataFrame([(1, 0, 59.0, 1.0), (1, 1, 59.1, 1.0), (2, 0, 59.0, 1.0)], "face long, file long, lat double, lon double")
    bad = steps.verified(axis, spec, 3600.0, places)
    assert [tuple(r) for r in bad.collect()] == [("coordinates", "1")]
    with pytest.raises(InvalidData):
        steps.tracking(axis, bad)


def test_layout_reads_few_files_and_joins_without_a_shuffle(spark, tmp_path):
    faces = spark.createDataFrame([(k, 59 + (k // 20) * 0.01, -152 + (k % 20) * 0.01) for k in range(400)], "face long, lat double, lon double")
    rows = faces.select("face").join(spark.range(5).select(F.col("id").alias("t"))).withColumn("time", F.timestamp_seconds("t").cast("timestamp_ntz")).withColumn("u", F.col("face") * 1.0 + F.col("t"))
    tile_of, index = layout.tiles_of_faces(faces, 16)
    assert index.agg(F.max("n")).first()[0] <= 16 and tile_of.count() == 400
    layout.write_series(rows, tile_of, "flow_layout", str(tmp_path / "flow"), 4)
    layout.write_series(rows.withColumnRenamed("u", "w"), tile_of, "other_layout", str(tmp_path / "other"), 4)
    area = layout.read_area(spark, "flow_layout", index, faces, 59.02, 59.05, -151.95, -151.92)
    assert sorted({r["face"] for r in area.collect()}) == [r["face"] for r in faces.where("lat between 59.02 and 59.05 and lon between -151.95 and -151.92").orderBy("face").collect()] and area.count() == 16 * 5
    met = index.where("lat1 <= 59.05 and lat2 >= 59.02 and lon1 <= -151.92 and lon2 >= -151.95").count()
    assert "PartitionFilters: [tile" in area._jdf.queryExecution().executedPlan().toString()
    tiles_read = [r["tile"] for r in index.where("lat1 <= 59.05 and lat2 >= 59.02 and lon1 <= -151.92 and lon2 >= -151.95").collect()]
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert met <= 5 and 4 * files(spark.table("flow_layout").where(F.col("tile").isin(tiles_read))) < files(spark.table("flow_layout"))
    # By face: neither side is shuffled, nor is the sum.
    layout.join_by_face(spark)
    joined = spark.table("flow_layout").join(spark.table("other_layout").hint("shuffle_hash"), ["face", "t"]).groupBy("face").agg(F.sum(F.col("u") * F.col("w")).alias("s"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and joined.count() == 400
    layout.register(spark, "time timestamp_ntz, u double, t long, face long", "flow_again", str(tmp_path / "flow"), 4)
    assert spark.table("flow_again").where("tile = 0").groupBy().agg(F.count("*")).first()[0] == 16 * 5
    for name in ("flow_layout", "other_layout", "flow_again"):
        spark.sql(f"DROP TABLE {name}")


def test_peaks_leave_nan_levels_out(spark):
    level = [math.sin(k / 2) for k in range(60)]
    rows = [(f, k, float("nan") if f == 1 and k in (0, 17) else x) for f in (0, 1) for k, x in enumerate(level)]
    df = spark.createDataFrame(rows, "face long, t long, zeta_center double").withColumn("time", F.timestamp_seconds(F.col("t") * 3600).cast("timestamp_ntz"))
    got = {r["face"]: r for r in tides.tidal_levels(tides.peaks(df)).collect()}
    assert got[1]["method"] == "peaks" and all(got[1][c] is not None and not math.isnan(got[1][c]) for c in ("max_high", "mean_low", "range_extremes"))
    assert math.isclose(got[1]["max_high"], got[0]["max_high"], abs_tol=0.1)


def test_orientation_and_shapes(spark):
    rows = [(1, "u", "units", "m"), (1, "v", "units", "m"), (1, "h", "positive", "down"), (2, "u", "units", "m"), (2, "v", "units", "km"), (3, "u", "units", "m"), (3, "h", "positive", "up")]
    got = records.orientation_breaks(spark.createDataFrame(rows, "file long, name string, key string, value string"), [("u", "v")], {"h": "down"}).collect()
    assert sorted(map(tuple, got)) == [(2, "not positive down: h"), (2, "other units: u, v"), (3, "no units: u, v"), (3, "not positive down: h")]
    values = [("u", 1, 0, 5), ("u", 1, 1, 5), ("z", 1, None, 5), ("z", 2, None, 6), ("h", None, None, 5), ("s", None, 0, None), ("t", 3, None, None)]
    found = records.variable_shapes(spark.createDataFrame(values, "name string, t long, sigma_layer long, face long")).collect()
    assert {tuple(r) for r in found} == {("u", "time, layer, face", 2, 1), ("z", "time, face", 0, 2), ("h", "face", 0, 1), ("s", "other", 1, 0), ("t", "other", 0, 0)}
