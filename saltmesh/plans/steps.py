"""The steps of a site's analysis, each a DataFrame to DataFrame function made of the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, names
from ..operators import derive, records, selection, sites, spatial, summary, tides, tiles, time_checks
from ..sources import tables


def verified(
    axis: DataFrame, spec: DataFrame, step: float, places: DataFrame | None = None, attributes: DataFrame | None = None, excluded: tuple[str, ...] = ("history",),
    components: DataFrame | None = None, wanted: DataFrame | None = None, declared: DataFrame | None = None, actual: DataFrame | None = None,
) -> DataFrame:
    """(check, key): every violation of a site's raw files. Of their time axis (file, pos, time): order, duplicates, step, and each file whole. And, of what is given: places (face, file, lat, lon) that differ between files, attributes (file, key, value) that do, components (file, component, kind) other than the wanted, and variables (name, type, units) other than those declared."""
    check = lambda name, rows, *key: rows.select(F.lit(name).alias("check"), F.concat_ws(":", *(F.col(k).cast("string") for k in key)).alias("key"))
    found = [
        check("order", time_checks.not_increasing(axis, ["file"], "time", "pos"), "file"),
        check("duplicate", time_checks.duplicates(axis, ["time"]), "time"),
        check("step", time_checks.off_specification(time_checks.step_statistics(axis, ["file"], "time", "pos"), step), "file"),
        check("incomplete", time_checks.incomplete(axis, ["file"], "time", spec), "file"),
    ]
    if places is not None:
        found.append(check("coordinates", time_checks.changed_between_files(places, ["face"], ["lat", "lon"]), "face"))
    if attributes is not None:
        found.append(check("attributes", records.unequal_attributes(attributes, list(excluded)), "key"))
    if components is not None:
        found.append(check("structure", records.structure_differences(components, wanted), "file", "component"))
    if declared is not None:
        found.append(check("specification", records.specification_violations(declared, actual), "name", "rule"))
    return reduce(DataFrame.unionByName, found)


def tracking(axis: DataFrame, violations: DataFrame) -> DataFrame:
    """(file, pos, time) of a site without violations, the table that later steps start from; raises if there are any."""
    time_checks.assert_valid(violations)
    return axis.select("file", "pos", "time")


def standardised(velocity: DataFrame, start: str, end: str, spec: dict[str, tuple[str, dict]], vocabulary: dict[str, str] | None = None, corners: DataFrame | None = None) -> DataFrame:
    """A site's rows in standard form: its window, the first of duplicate times, no NaN, the names of the vocabulary, the declared columns and types with their attributes, and the corners (face, …) of each face."""
    rows = time_checks.in_window(velocity, "time", F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    rows = time_checks.first_of_each(rows, ["face", "sigma_layer", "time"], "t")
    rows = rows.withColumns({c: derive.no_nan(F.col(c)) for c in ("u", "v")})
    out = derive.standardised(derive.renamed(rows, vocabulary or {}), spec)
    return out if corners is None else out.join(corners, "face", "left")


def derived(velocity: DataFrame, columns: DataFrame, sigma: DataFrame, constants: DataFrame | None = None) -> DataFrame:
    """Speed, direction, power and depth for each face, time and layer, with mean, median, maximum and 95th percentile of its water column, and the constants (face, …) of its face."""
    flow = derive.with_flow(velocity)
    depth = derive.with_sigma_depth(columns, sigma).select("face", "t", "sigma_layer", "sea_floor_depth", "surface_elevation", "sigma_depth")
    out = flow.join(depth, ["face", "t", "sigma_layer"])
    for value in ("speed", "power_density"):
        out = out.join(summary.column_statistics(flow, value, ["face", "t"]), ["face", "t"])
    return out if constants is None else derive.attach(out, constants, [c for c in constants.columns if c != "face"])


def monthly(layers: DataFrame, surface: DataFrame) -> DataFrame:
    """(year, month, face): means, maxima and percentiles of speed and power over times and layers, and mean and extremes of the level."""
    by = [F.year("time").alias("year"), F.month("time").alias("month"), "face"]
    p95 = lambda c: F.percentile(c, F.lit(0.95)).alias(f"p95_{c}")
    flow = layers.groupBy(*by).agg(*(x for c in ("speed", "power_density") for x in (F.avg(c).alias(f"mean_{c}"), F.max(c).alias(f"max_{c}"), p95(c))), F.count("speed").alias("n"))
    level = surface.groupBy(*by).agg(F.avg("zeta_center").alias("mean_level"), F.min("zeta_center").alias("low_level"), F.max("zeta_center").alias("high_level"))
    return flow.join(level, ["year", "month", "face"], "left")


def yearly(layers: DataFrame, surface: DataFrame) -> DataFrame:
    """One row per face: means and maxima, percentiles, flood and ebb of the surface layer, tidal levels and periods."""
    flow = layers.groupBy("face").agg(F.avg("speed").alias("mean_speed"), F.max("speed").alias("max_speed"), F.percentile("speed", F.lit(0.95)).alias("p95_speed"), F.avg("power_density").alias("mean_power"))
    phases = tides.tide_phase(surface, ["face"]).select("face", "t", "phase").where("phase is not null")
    modes = tides.direction_modes(layers.where("sigma_layer = 0").join(phases, ["face", "t"]), ["face", "phase"])
    both = modes.groupBy("face").agg(*(F.max(F.when(F.col("phase") == p, F.col("direction"))).alias(f"{p}_direction") for p in ("flood", "ebb")))
    report = tides.surface_report(tides.peaks(surface))
    return flow.join(both, "face", "left").join(report.drop("n_periods", "n_cycles"), "face", "left")


def atlas(layers: DataFrame, faces: DataFrame, nodes: DataFrame, n_layers: int, styles: dict[str, tuple[float, float, list[str]]], location: Column, dataset: str = "tidal", period: str = "1h") -> DataFrame:
    """The wide table, in fixed order: location, face and its id, place, path, mean, ratio of p95 to mean, a column for each layer, colours of the styled columns, corners and outline. location is an expression of face."""
    by_layer = layers.groupBy("face", "sigma_layer").agg(F.avg("speed").alias("speed"))
    wide = summary.pivot_layers(by_layer, ["face"], "speed", list(range(n_layers)))
    stats = summary.summary(layers, "speed", ["face"]).select("face", "mean", derive.max_to_mean(F.col("p95"), F.col("mean")).alias("ratio"))
    at = derive.with_corner_coordinates(faces, nodes).drop("n1", "n2", "n3", "h_center")
    centre = lambda x: (F.col(f"{x}_1") + F.col(f"{x}_2") + F.col(f"{x}_3")) / 3
    out = wide.join(stats, "face").join(at, "face").withColumns({"location": location, "lat": centre("lat"), "lon": centre("lon")})
    file = names.point_file(F.col("location"), F.lit(dataset), F.col("face"), F.col("lat"), F.col("lon"), F.lit(period))
    out = out.withColumns({"face_id": derive.face_id(F.col("face")), "path": F.concat_ws("/", "location", geo.partition_path(F.col("lat"), F.col("lon")), file)})
    out = sites.fill_colours(out, styles).withColumn("outline", geo.triangle_wkt([(F.col(f"lon_{k}"), F.col(f"lat_{k}")) for k in (1, 2, 3)]))
    ends = [f"{c}_{k}" for c in ("lon", "lat") for k in (1, 2, 3)]
    return out.select("location", "face", "face_id", "lat", "lon", "path", "mean", "ratio", *(f"speed_sigma_level_{k}" for k in range(n_layers)), *(f"fill_color_{c}" for c in styles), *ends, "outline")


def all_locations(tables_of: list[DataFrame], labels: DataFrame) -> DataFrame:
    """Wide tables of several locations as one, with the label (location, label) of each, numbered anew in the order of location and face."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables_of)
    return tables.numbered(rows.join(labels, "location", "left"), ["location", "face"], "index")


def lookup(queries: DataFrame, points: DataFrame, versions: DataFrame, series: DataFrame, metres: float, version: str | None = None, dataset: str = "tidal", period: str = "1h") -> DataFrame:
    """Series (face, …) of the nearest point (location, face, lat, lon) of each query within a limit, with its distance, the data version asked for, or the latest of its location, the number of versions there are, and the path of its file. Points of locations without that version are left out."""
    found = tiles.within_limit(tiles.nearest(queries, points), metres).where("ok").drop("ok").join(points, "face")
    known = records.latest_versions(versions)
    if version is not None:
        known = known.join(versions.where(F.col("version") == version).select("location").distinct(), "location").withColumn("latest", F.lit(version))
    out = found.join(known.select("location", F.col("latest").alias("version"), "n_versions"), "location")
    file = names.point_file(F.col("location"), F.lit(dataset), F.col("face"), F.col("lat"), F.col("lon"), F.lit(period))
    out = out.withColumn("path", F.concat_ws("/", "location", F.concat(F.lit("v"), "version"), geo.partition_path(F.col("lat"), F.col("lon")), file))
    return out.join(series, "face", "left")


def regions(rows: DataFrame, region: str, variables: dict[str, float], shares: tuple[float, ...] = (0.95, 0.99, 0.9999)) -> DataFrame:
    """(region, variable, n, min, max, mean, std, p95, p99, p9999, kept_percent) of all variables of all regions, and of all regions together (region null); variables names the upper end of each variable's shown range. A null region counts in the whole alone."""
    long = rows.unpivot([region], list(variables), "variable", "value")
    shown = F.element_at(F.create_map(*(x for v, most in variables.items() for x in (F.lit(v), F.lit(float(most))))), F.col("variable"))
    others = {"n": F.count("value"), "min": F.min("value"), "max": F.max("value"), "mean": F.avg("value"), "std": F.stddev_pop("value"), "kept_percent": 100 * F.avg(F.when(F.col("value") <= F.col("_shown"), 1.0).when(F.col("value").isNotNull(), 0.0))}
    long = long.withColumn("_shown", shown)
    each = selection.percentiles(long.where(F.col(region).isNotNull()), [region, "variable"], "value", list(shares), others)
    whole = selection.percentiles(long, ["variable"], "value", list(shares), others).withColumn(region, F.lit(None).cast(rows.schema[region].dataType))
    names_of = [f"p{f'{100 * q:g}'.replace('.', '')}" for q in shares]
    return each.unionByName(whole).select(region, "variable", *others, *(F.col("q")[k].alias(n) for k, n in enumerate(names_of)))


def exported(rows: DataFrame, expected: DataFrame, values: list[str], layers: list[int], chunk: Column, fill: float = -999.0) -> DataFrame:
    """rows (face, time, sigma_layer, values) as a year for export: a column for each value and layer, every expected (face, time), gaps filled, times as text. Raises if a chunk of the times that there are lacks a variable that most have."""
    variables = rows.select(chunk.alias("chunk"), F.explode(F.array_compact(F.array(*(F.when(F.col(v).isNotNull(), F.lit(v)) for v in values)))).alias("variable")).distinct()
    time_checks.assert_valid(records.incomplete_chunks(variables, rows.select(chunk.alias("chunk")).distinct()))
    picks = [F.max(F.when(F.col("sigma_layer") == k, F.col(v))).alias(f"{v}_sigma_layer_{k:02d}") for v in values for k in layers]
    wide = rows.groupBy("face", "time").agg(*picks)
    columns = [c for c in wide.columns if c not in ("face", "time")]
    out = time_checks.padded(wide, expected, ["face", "time"], columns, fill)
    return out.withColumn("time_index", F.date_format("time", "yyyy-MM-dd HH:mm:ss'+00:00'")).select("face", "time_index", *columns)


def transect(faces: DataFrame, lat: float, lon: float, bearing: float, km: float) -> DataFrame:
    """Faces (corner columns) that a line from a place crosses, with the middle of the crossing and the way to it, up to a gap that is the shore.

    In the line's own frame a face is cut where its corners lie on both sides; the way in and out are where its sides
    meet the line.
    """
    import math

    per = math.pi * geo.RADIUS_KM / 180
    ex, ey = math.sin(math.radians(bearing)), math.cos(math.radians(bearing))
    x = lambda k: (F.col(f"lon_{k}") - lon) * (per * math.cos(math.radians(lat)))
    y = lambda k: (F.col(f"lat_{k}") - lat) * per
    along = [x(k) * ex + y(k) * ey for k in (1, 2, 3)]
    side = [x(k) * ey - y(k) * ex for k in (1, 2, 3)]
    meets = [F.when((side[a] > 0) != (side[b] > 0), along[a] + (along[b] - along[a]) * side[a] / (side[a] - side[b])) for a, b in ((0, 1), (1, 2), (2, 0))]
    out = faces.withColumn("into", F.least(*meets)).withColumn("out_of", F.greatest(*meets)).where(F.col("into").isNotNull())
    out = out.withColumn("along", (F.col("into") + F.col("out_of")) / 2).where(F.col("along").between(0, km))
    return spatial.trimmed_at_shore(out.withColumn("line", F.lit(0)), "line").drop("line")


def transect_both_ways(faces: DataFrame, layers: DataFrame, lat: float, lon: float, bearing: float, km: float) -> DataFrame:
    """The section through a place: faces crossed ahead (positive ways) and behind it (negative ones), each up to its shore, with the mean speed of each layer and the edges of their cells along the line."""
    ahead = transect(faces, lat, lon, bearing, km)
    back = transect(faces, lat, lon, bearing + 180, km).where("along > 0")
    back = back.withColumns({"along": -F.col("along"), "into": -F.col("out_of"), "out_of": -F.col("into")})
    columns = ["face", "along", "into", "out_of"]
    both = spatial.cell_edges(ahead.select(columns).unionByName(back.select(columns)).withColumn("line", F.lit(0)), ["line"], "along").drop("line")
    means = layers.groupBy("face", "sigma_layer").agg(F.avg("speed").alias("speed"))
    return both.join(means, "face", "left")
