"""File names, paths, versions and texts, taken apart and put together as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name of a point file: location.dataset.face=N.lat=Y.lon=X-period.parquet, the period being optional.
POINT = r"^([A-Za-z0-9_]+)\.([a-z0-9_]+)\.face=([0-9]+)\.lat=(-?[0-9.]+?)\.lon=(-?[0-9.]+?)(?:-([0-9a-z_]+))?\.parquet$"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"(\.[^./]+)$", 1)


def point_file(location: Column, dataset: Column, face: Column, lat: Column, lon: Column, period: Column) -> Column:
    return F.concat(location, F.lit("."), dataset, F.format_string(".face=%d.lat=%.7f.lon=%.7f", face, lat, lon), F.lit("-"), period, F.lit(".parquet"))


def parse_point_file(name: Column) -> dict[str, Column]:
    """Parts of a point file's name, null where it is none."""
    part = lambda k: F.when(name.rlike(POINT), F.nullif(F.regexp_extract(name, POINT, k), F.lit("")))
    kinds = (("location", "string"), ("dataset", "string"), ("face", "long"), ("lat", "double"), ("lon", "double"), ("period", "string"))
    return {n: part(k).cast(t) for k, (n, t) in enumerate(kinds, 1)}


def parse_partition_path(path: Column) -> dict[str, Column]:
    return {k: F.regexp_extract(path, rf"{k}=(-?[0-9]+)", 1).try_cast("int") for k in ("lat_deg", "lon_deg", "lat_dec", "lon_dec")}


def product_file(number: Column, location: Column, dataset: Column, level: Column, date: Column, version: Column) -> Column:
    return F.concat_ws(".", F.lpad(number.cast("string"), 3, "0"), location, dataset, level, F.concat(F.lit("v"), version), date, F.lit("nc"))


def parse_product_file(name: Column) -> dict[str, Column]:
    p = F.split(name, r"\.")
    return {"number": p[0].try_cast("int"), "location": p[1], "dataset": p[2], "level": p[3], "version": F.regexp_extract(name, r"\.v(\d+\.\d+\.\d+)\.", 1), "date": F.element_at(p, -2), "ext": F.element_at(p, -1)}


def semver(version: Column) -> Column:
    """(major, minor, patch) that compares as versions do."""
    p = F.split(version, r"\.")
    return F.struct(*(p[k].cast("int").alias(n) for k, n in enumerate(("major", "minor", "patch"))))


def next_patch(version: Column) -> Column:
    v = semver(version)
    return F.concat_ws(".", *(x.cast("string") for x in (v["major"], v["minor"], v["patch"] + 1)))


def face_batch(name: Column) -> dict[str, Column]:
    """First and last face and base name of base.faces=000000-009999.nc."""
    pattern = r"^(.*)\.faces=(\d+)-(\d+)\.nc$"
    return {"base": F.regexp_extract(name, pattern, 1), "start": F.regexp_extract(name, pattern, 2).try_cast("long"), "end": F.regexp_extract(name, pattern, 3).try_cast("long")}


def decode_time(value: Column, units: Column) -> Column:
    """A number in units such as 'hours since 2005-01-01 00:00:00' as a timestamp."""
    unit = F.regexp_extract(units, r"^(\w+) since", 1)
    start = F.regexp_extract(units, r"since (.*)$", 1).cast("timestamp_ntz")
    seconds = F.when(unit == "days", 86400).when(unit == "hours", 3600).when(unit == "minutes", 60).otherwise(1)
    return (start + F.make_dt_interval(secs=(value * seconds).cast("double"))).cast("timestamp_ntz")


def history_date(history: Column) -> Column:
    """The date in a model's history such as 'Sat Jan  1 02:03:04 2005'."""
    p = lambda k: F.regexp_extract(history, r"(\w{3})\s+(\d+)\s+(\d\d:\d\d:\d\d)\s+(\d{4})", k)
    month = F.lpad(((F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), p(1)) + 2) / 3).cast("int").cast("string"), 2, "0")
    return F.concat(p(4), F.lit("-"), month, F.lit("-"), F.lpad(p(2), 2, "0"), F.lit("T"), p(3))


def colour_class(value: Column, low: float, high: float, n: int) -> Column:
    """Number of the colour class, clipped to the range; null for null."""
    return F.when(value.isNotNull() & ~F.isnan(value), F.least(F.greatest(F.floor((value - low) / ((high - low) / n)), F.lit(0)), F.lit(n - 1)).cast("int"))


def range_class(value: Column, limits: list[float]) -> Column:
    """Number of the first limit that the value doesn't exceed."""
    out = F.when(value <= limits[0], 0)
    for k, x in enumerate(limits[1:], 1):
        out = out.when(value <= x, k)
    return out.otherwise(len(limits))


def range_label(low: Column, high: Column, unit: str) -> Column:
    """A class's range, with decimals by its size; an open top for a null high."""
    text = lambda x: F.when(F.abs(x) >= 100, F.format_string("%.0f", x)).when(F.abs(x) >= 1, F.format_string("%.1f", x)).otherwise(F.format_string("%.2f", x))
    return F.when(high.isNull(), F.concat(F.lit(">= "), text(low), F.lit(f" {unit}"))).otherwise(F.concat(text(low), F.lit("-"), text(high), F.lit(f" {unit}")))
