"""Ledgers, attributes and versions as tables: what changed, what is missing, what comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..sources.scratch import broadcast_if_few


def unequal_attributes(attributes: DataFrame, allowed: list[str]) -> DataFrame:
    """attributes (file, key, value): keys, but for those allowed, that differ between files or lack in some."""
    files = attributes.agg(F.count_distinct("file").alias("_files"))
    out = attributes.where(~F.col("key").isin(allowed)).groupBy("key").agg(F.count_distinct("value").alias("n_values"), F.count_distinct("file").alias("n_files"))
    return out.crossJoin(F.broadcast(files)).where("n_values > 1 or n_files < _files").drop("_files")


def structure_differences(actual: DataFrame, reference: DataFrame) -> DataFrame:
    """(file, component, kind) against (component, kind): what is missing, extra or of another kind in each file."""
    want = actual.select("file").distinct().crossJoin(broadcast_if_few(reference.withColumnRenamed("kind", "expected")))
    out = want.join(actual, ["file", "component"], "full_outer")
    return out.where(~F.col("kind").eqNullSafe(F.col("expected"))).select("file", "component", "expected", "kind")


def specification_violations(spec: DataFrame, actual: DataFrame) -> DataFrame:
    """spec (name, type, units) left-joined to actual (name, type, units): one row per broken rule."""
    out = spec.join(actual.select("name", F.col("type").alias("a_type"), F.col("units").alias("a_units")), "name", "left")
    rule = F.when(F.col("a_type").isNull(), "missing").when(F.col("a_type") != F.col("type"), "type").when(~F.col("a_units").eqNullSafe(F.col("units")), "units")
    return out.withColumn("rule", rule).where("rule is not null").select("name", "rule")


def filled_attributes(spec: DataFrame, actual: DataFrame) -> DataFrame:
    """Attributes of spec (name, key, value) with those of actual where they have one; conflict marks other values."""
    out = spec.join(actual.withColumnRenamed("value", "own"), ["name", "key"], "left")
    return out.select("name", "key", F.coalesce("own", "value").alias("value"), (F.col("own").isNotNull() & (F.col("own") != F.col("value"))).alias("conflict"))


def orientation_breaks(attributes: DataFrame, same: list[tuple[str, str]], wanted: dict[str, str]) -> DataFrame:
    """(file, problem) of attributes (file, name, key, value): pairs of variables that lack units or have other ones than each other, and variables whose `positive` isn't the wanted. Each file is judged by itself, in one sum."""
    value = lambda name, key: F.max(F.when((F.col("name") == name) & (F.col("key") == key), F.col("value")))
    needed = sorted({x for pair in same for x in pair})
    held = attributes.groupBy("file").agg(*(value(n, "units").alias(f"u_{n}") for n in needed), *(value(n, "positive").alias(f"p_{n}") for n in wanted))
    units = [F.when(F.col(f"u_{a}").isNull() | F.col(f"u_{b}").isNull(), F.lit(f"no units: {a}, {b}")).when(F.col(f"u_{a}") != F.col(f"u_{b}"), F.lit(f"other units: {a}, {b}")) for a, b in same]
    ways = [F.when(~F.col(f"p_{n}").eqNullSafe(F.lit(w)), F.lit(f"not positive {w}: {n}")) for n, w in wanted.items()]
    return held.select("file", F.explode(F.array_compact(F.array(*units, *ways))).alias("problem"))


def variable_shapes(values: DataFrame) -> DataFrame:
    """(name, shape, n_layers, n_faces) of values (name, t, sigma_layer, face), where what a variable has not is null: by time, layer and face, by time and face, by face, or other."""
    out = values.groupBy("name").agg(F.count("t").alias("_t"), F.count("face").alias("_f"), F.count_distinct("sigma_layer").alias("n_layers"), F.count_distinct("face").alias("n_faces"))
    timed, faced, layered = F.col("_t") > 0, F.col("_f") > 0, F.col("n_layers") > 0
    shape = F.when(timed & layered & faced, "time, layer, face").when(timed & faced & ~layered, "time, face").when(faced & ~layered, "face").otherwise("other")
    return out.select("name", shape.alias("shape"), "n_layers", "n_faces")


def outside(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value is null, NaN or not in the range."""
    c = F.col(column)
    return rows.where(c.isNull() | F.isnan(c) | ~c.between(low, high))


def uneven_layers(layers: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """layers (node, sigma_layer, sigma): layers that differ between nodes, or from -(k + 1/2) / n."""
    n = layers.agg((F.max("sigma_layer") + 1).alias("n"))
    out = layers.groupBy("sigma_layer").agg(F.var_pop("sigma").alias("spread"), F.avg("sigma").alias("mean")).crossJoin(F.broadcast(n))
    want = -(F.col("sigma_layer") + 0.5) / F.col("n")
    return out.withColumn("wanted", want).where((F.col("spread") > tolerance) | (F.abs(F.col("mean") - F.col("wanted")) > tolerance))


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_null) of all columns in one pass, those without nulls left out."""
    counted = rows.agg(*(F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns))
    return counted.unpivot([], columns, "column", "n_null").where("n_null > 0")


def mismatched(a: DataFrame, b: DataFrame, key: str, value: str, relative: float, absolute: float = 1e-8) -> DataFrame:
    """Keys that one side lacks, or whose values are too far apart."""
    out = a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key, "full_outer")
    return out.where(F.col("a").isNull() | F.col("b").isNull() | (F.abs(F.col("a") - F.col("b")) > relative * F.abs(F.col("b")) + absolute))


def unauthorised_changes(old: DataFrame, new: DataFrame, allowed: list[str], geo_keys: list[str], degrees: float = 1e-4) -> DataFrame:
    """(key, value) before and after: changed keys that may not change; geo keys may move by some degrees."""
    out = old.withColumnRenamed("value", "before").join(new.withColumnRenamed("value", "after"), "key", "full_outer")
    moved = F.col("key").isin(geo_keys) & (F.abs(F.col("before").try_cast("double") - F.col("after").try_cast("double")) <= degrees)
    return out.where(~F.col("before").eqNullSafe(F.col("after")) & ~F.col("key").isin(allowed) & ~F.coalesce(moved, F.lit(False)))


def misnamed(files: DataFrame) -> DataFrame:
    """Files (name) that are no point files."""
    return files.where(~F.col("name").rlike(names.POINT))


def incomplete_chunks(chunks: DataFrame, expected: DataFrame) -> DataFrame:
    """chunks (chunk, variable) against expected (chunk): chunks that lack, or that have other variables than most."""
    lists = chunks.groupBy("chunk").agg(F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("variables"))
    usual = lists.groupBy("variables").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "variables").limit(1).select(F.col("variables").alias("usual"))
    out = expected.join(lists, "chunk", "left").crossJoin(F.broadcast(usual))
    return out.withColumn("problem", F.when(F.col("variables").isNull(), "missing").when(F.col("variables") != F.col("usual"), "other variables")).where("problem is not null").select("chunk", "problem")


def existing_pending(ledger: DataFrame, remote: DataFrame) -> DataFrame:
    """Pending files whose name already stands in remote (path), as skipped."""
    have = remote.select(names.file_name(F.col("path")).alias("name")).distinct()
    return ledger.where("upload_status = 'pending'").withColumn("name", names.file_name(F.col("s3_destination"))).join(have, "name", "left_semi").withColumn("upload_status", F.lit("skipped"))


def merged_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Version histories (location, version, date) as one; the new one's dates win."""
    out = old.withColumnRenamed("date", "_old").join(new.withColumnRenamed("date", "_new"), ["location", "version"], "full_outer")
    return out.select("location", "version", F.coalesce("_new", "_old").alias("date"))


def latest_versions(versions: DataFrame) -> DataFrame:
    best = versions.groupBy("location").agg(F.max(F.struct(names.semver(F.col("version")).alias("v"), "version")).alias("b"), F.count("*").alias("n_versions"))
    return best.select("location", F.col("b.version").alias("latest"), "n_versions")


def current_status(events: DataFrame) -> DataFrame:
    """events (file_index, at, status): the latest status of each file; of one time the largest."""
    return events.groupBy("file_index").agg(F.max(F.struct("at", "status")).alias("b")).select("file_index", "b.status", "b.at")


def batch_of(files: DataFrame, order: Column, n: int, k: int) -> DataFrame:
    """The k-th batch of n files. The number is counted per status, so that one sort does."""
    numbered = files.withColumn("_n", F.row_number().over(Window.partitionBy("upload_status").orderBy(order)))
    return numbered.where(F.floor((F.col("_n") - 1) / n) == k).drop("_n")


def array_differences(rows: DataFrame, expected: str, actual: str) -> DataFrame:
    """Sorted elements that are missing from and extra in actual."""
    return rows.withColumn("missing", F.array_sort(F.array_except(expected, actual))).withColumn("extra", F.array_sort(F.array_except(actual, expected)))


def schema_report(df: DataFrame) -> DataFrame:
    """(column, type, n_values, n_null) of a table, in one pass."""
    kinds = dict(df.dtypes)
    counted = df.agg(*(F.struct(F.count_distinct(c).alias("n_values"), F.sum(F.col(c).isNull().cast("long")).alias("n_null")).alias(c) for c in df.columns))
    rows = counted.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(c)["n_values"].alias("n_values"), F.col(c)["n_null"].alias("n_null")) for c in df.columns))).alias("r"))
    return rows.select("r.*")


def discrete_bounds(spec: DataFrame) -> DataFrame:
    """spec (max) to classes with the maximum before as their lower bound, and an open one on top."""
    w = Window.orderBy("max")
    out = spec.select("max").distinct().withColumn("low", F.coalesce(F.lag("max").over(w), F.lit(0.0)))
    top = spec.agg(F.max("max").alias("low")).select(F.lit(None).cast("double").alias("high"), "low")
    return out.select(F.col("max").alias("high"), "low").unionByName(top)
