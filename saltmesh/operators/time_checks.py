"""Checks of time axes, and filling and cutting of series. Checks return rows that violate them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class InvalidData(ValueError):
    """Raised by assert_valid."""


def assert_valid(violations: DataFrame) -> None:
    """Raises if there is a violation; names the first few."""
    if found := violations.limit(5).collect():
        raise InvalidData("; ".join(str(r.asDict()) for r in found))


def violation(check: str, key: Column, expected: Column, actual: Column) -> list[Column]:
    return [F.lit(check).alias("check"), key.cast("string").alias("key"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual")]


def seconds(time: Column) -> Column:
    """Seconds of a timestamp, with fractions."""
    return F.unix_micros(time.cast("timestamp")) / 1e6


def with_step(rows: DataFrame, keys: list[str], time: str, order: str) -> DataFrame:
    """rows with the time before in its series and the step to it in seconds."""
    before = F.lag(time).over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("before", before).withColumn("step", seconds(F.col(time)) - seconds(F.col("before")))


def not_increasing(rows: DataFrame, keys: list[str], time: str, order: str) -> DataFrame:
    return with_step(rows, keys, time, order).where("step <= 0")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def step_statistics(rows: DataFrame, keys: list[str], time: str, order: str) -> DataFrame:
    steps = with_step(rows, keys, time, order).where("step is not null")
    return steps.groupBy(*keys).agg(F.avg("step").alias("mean_step"), F.min("step").alias("min_step"), F.max("step").alias("max_step"), F.count("*").alias("n_steps"))


def off_specification(statistics: DataFrame, expected: float, tolerance: float = 1e-3) -> DataFrame:
    """Series whose mean, shortest or longest step is not the expected one."""
    off = [F.abs(F.col(c) - expected) > tolerance for c in ("mean_step", "min_step", "max_step")]
    return statistics.where(off[0] | off[1] | off[2])


def spacing_label(rows: DataFrame, keys: list[str], time: str, order: str, tolerance: float = 0.0) -> DataFrame:
    """1h, 30m or irregular, by the largest deviation from the first step."""
    steps = with_step(rows, keys, time, order).where("step is not null")
    out = steps.groupBy(*keys).agg(F.min_by("step", order).alias("first_step"), F.min("step").alias("lo"), F.max("step").alias("hi"))
    even = F.greatest(F.abs(F.col("hi") - F.col("first_step")), F.abs(F.col("lo") - F.col("first_step"))) <= tolerance
    return out.withColumn("label", F.when(~even, "irregular").when(F.col("first_step") == 3600, "1h").when(F.col("first_step") == 1800, "30m").otherwise(F.concat(F.col("first_step").cast("long").cast("string"), F.lit("s"))))


def incomplete(rows: DataFrame, keys: list[str], time: str, spec: DataFrame) -> DataFrame:
    """Series that start late, end early, or have another step than spec (keys, start, end, step) says."""
    stats = step_statistics(rows, keys, time, time).join(rows.groupBy(*keys).agg(F.min(time).alias("first"), F.max(time).alias("last")), keys)
    out = spec.join(stats, keys, "left")
    problem = (
        F.when(F.col("first").isNull(), "no data").when(F.col("first") > F.col("start"), "starts late").when(F.col("last") < F.col("end"), "ends early")
        .when((F.col("min_step") != F.col("step")) | (F.col("max_step") != F.col("step")), "uneven steps")
    )
    return out.withColumn("problem", problem).where("problem is not null")


def broken_continuity(files: DataFrame, expected_step: float) -> DataFrame:
    """files (location, file, first, last, n) whose first time is not one step after the file before."""
    before = F.lag("last").over(Window.partitionBy("location").orderBy("file"))
    return files.withColumn("gap", seconds(F.col("first")) - seconds(before)).where(F.col("gap").isNotNull() & (F.abs(F.col("gap") - expected_step) > 1e-3))


def first_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Duplicates dropped, the first kept."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def in_window(rows: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    return rows.where(F.col(time).between(start, end))


def synthesised(files: DataFrame, reference: Column, step: int) -> DataFrame:
    """files (location, file, n_steps) to (location, file, pos, time): the axis runs on over the files in order."""
    w = Window.partitionBy("location").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    out = files.withColumn("offset", F.coalesce(F.sum("n_steps").over(w), F.lit(0)))
    out = out.withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("n_steps").cast("int") - 1)))
    time = reference + F.make_dt_interval(secs=((F.col("offset") + F.col("pos")) * step).cast("double"))
    return out.select("location", "file", "pos", time.cast("timestamp_ntz").alias("time"))


def timeline(spec: DataFrame, step: str) -> DataFrame:
    """(keys, time): every expected time of spec (keys, start, end)."""
    return spec.withColumn("time", F.explode(F.sequence("start", "end", F.expr(f"INTERVAL {step}")))).drop("start", "end")


def padded(rows: DataFrame, expected: DataFrame, keys: list[str], values: list[str], fill: float = -999.0) -> DataFrame:
    """Every expected row, with fill where there is none."""
    return expected.join(rows, keys, "left").withColumns({v: F.coalesce(v, F.lit(fill)) for v in values})


def unmatched(expected: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Times that one side alone has."""
    left = expected.select(*keys).join(rows.select(*keys), keys, "left_anti").withColumn("side", F.lit("missing"))
    return left.unionByName(rows.select(*keys).join(expected.select(*keys), keys, "left_anti").withColumn("side", F.lit("extra")))


def ranges(rows: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Runs of neighbouring indices: (keys, first, last, n)."""
    w = Window.partitionBy(*keys).orderBy(index)
    out = rows.withColumn("_island", F.col(index) - F.row_number().over(w))
    return out.groupBy(*keys, "_island").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n")).drop("_island")


def range_text(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs as text, as in 1-3,5."""
    one = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", F.col("first").cast("string"), F.col("last").cast("string")))
    listed = F.array_sort(F.collect_list(F.struct("first", one.alias("text"))))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["text"]), ",").alias("indices"))


def batch_gaps(batches: DataFrame) -> DataFrame:
    """batches (location, start, end) that don't follow the one before, or don't begin at 0."""
    before = F.lag("end").over(Window.partitionBy("location").orderBy("start"))
    return batches.withColumn("wanted", F.coalesce(before + 1, F.lit(0))).where(F.col("start") != F.col("wanted"))


def changed_between_files(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys of which some value is not the same in all files."""
    out = rows.groupBy(*keys).agg(*(F.min(v).alias(f"{v}_lo") for v in values), *(F.max(v).alias(f"{v}_hi") for v in values))
    odd = F.lit(False)
    for v in values:
        odd = odd | (F.col(f"{v}_lo") != F.col(f"{v}_hi"))
    return out.where(odd)


def missing_batches(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).join(found.select(*keys), keys, "left_anti")
