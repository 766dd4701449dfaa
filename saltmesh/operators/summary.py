"""Summaries per face, layer and period, histograms, statistics of regions, and shapes of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .selection import percentiles


def period_month(time: Column) -> Column:
    return F.date_trunc("month", time).cast("timestamp_ntz")


def period_days(time: Column, first: Column, n: int) -> Column:
    """Number of the n-day period, counted from the first midnight of the location."""
    return F.floor(F.date_diff(F.to_date(time), F.to_date(first)) / F.lit(n)).cast("long")


def column_statistics(layers: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Mean, median, maximum and 95th percentile over the layers of each key: a water column has some ten values."""
    return layers.groupBy(*keys).agg(
        F.avg(value).alias(f"{value}_mean"), F.median(value).alias(f"{value}_median"), F.max(value).alias(f"{value}_max"), F.percentile(value, F.lit(0.95)).alias(f"{value}_p95")
    )


def column_statistics_of_arrays(profiles: DataFrame, array: str) -> DataFrame:
    """The same where the layers of a column stand in an array, without Python and without a shuffle."""
    a = F.array_sort(F.col(array))
    n = F.size(a)

    def quantile(q: float) -> Column:
        at = (n - 1) * F.lit(q)
        low = F.floor(at).cast("int")
        high = F.least(low + 1, n - 1)
        return F.element_at(a, low + 1) + (F.element_at(a, high + 1) - F.element_at(a, low + 1)) * (at - low)

    total = F.aggregate(array, F.lit(0.0), lambda s, x: s + x)
    return profiles.withColumn(f"{array}_mean", total / n).withColumn(f"{array}_median", quantile(0.5)).withColumn(f"{array}_max", F.array_max(array)).withColumn(f"{array}_p95", quantile(0.95))


def quantiles(value: str, shares: list[float], exact: bool = True, accuracy: int = 10_000) -> Column:
    """Interpolated percentiles; the approximate form keeps a bounded sketch for very long series."""
    return F.percentile(value, F.array(*map(F.lit, shares))) if exact else F.percentile_approx(value, shares, accuracy)


def summary(rows: DataFrame, value: str, keys: list[str], shares: tuple[float, ...] = (0.95, 0.99), exact: bool = True) -> DataFrame:
    """n, mean, min, max and percentiles over time steps: one shuffle, with partial sums before it."""
    q = quantiles(value, list(shares), exact)
    out = rows.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), q.alias("_q"))
    return out.select(*keys, "n", "mean", "min", "max", *(F.col("_q")[k].alias(f"p{round(s * 100)}") for k, s in enumerate(shares)))


def file_maxima(rows: DataFrame, value: str, keys: list[str], file: Column) -> DataFrame:
    """Maximum of each key in each file, the form whose percentiles some products report."""
    return rows.groupBy(*keys, file.alias("file")).agg(F.max(value).alias("file_max"))


def file_max_percentiles(rows: DataFrame, value: str, keys: list[str], file: Column) -> DataFrame:
    q = F.percentile("file_max", F.array(F.lit(0.95), F.lit(0.99)))
    out = file_maxima(rows, value, keys, file).groupBy(*keys).agg(F.max("file_max").alias("max"), q.alias("_q"))
    return out.select(*keys, "max", F.col("_q")[0].alias("p95"), F.col("_q")[1].alias("p99"))


def monthly_and_yearly(rows: DataFrame, value: str, key: str = "face") -> DataFrame:
    """Means and maxima by month and for the year in one pass, by grouping sets; month is 0 in the yearly rows."""
    rows = rows.withColumn("year", F.year("time")).withColumn("month", F.month("time"))
    out = rows.groupingSets([["year", "month", key], ["year", key]], "year", "month", key)
    return out.agg(F.avg(value).alias("mean"), F.max(value).alias("max"), F.count(value).alias("n")).withColumn("month", F.coalesce("month", F.lit(0)))


def pivot_layers(rows: DataFrame, keys: list[str], value: str, layers: list[int], suffix: str = "_sigma_level_") -> DataFrame:
    """Layers to columns, with the layers given: no pass to find them."""
    return rows.groupBy(*keys).agg(*(F.max(F.when(F.col("sigma_layer") == k, F.col(value))).alias(f"{value}{suffix}{k}") for k in layers))


def spread_columns(statistics: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of statistics to rows (keys, statistic, value)."""
    names = [c for c in statistics.columns if c not in keys]
    return statistics.unpivot(keys, names, "statistic", "value")


def boundary_edges(faces: DataFrame) -> DataFrame:
    """(a, b) with a < b: the edges that one triangle alone has."""
    edge = F.explode(F.array(*(F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")) for x, y in (("n1", "n2"), ("n2", "n3"), ("n3", "n1")))))
    return faces.select(edge.alias("e")).groupBy("e.a", "e.b").agg(F.count("*").alias("n")).where("n = 1").select("a", "b")


def region_statistics(rows: DataFrame, region: str, value: str) -> DataFrame:
    """Count, extremes, mean, deviation and high percentiles per region, by selection: a region may hold any number of rows."""
    others = {"n": F.count(value), "min": F.min(value), "max": F.max(value), "mean": F.avg(value), "std": F.stddev_pop(value)}
    out = percentiles(rows, [region], value, [0.95, 0.99, 0.9999], others)
    return out.select(region, *others, F.col("q")[0].alias("p95"), F.col("q")[1].alias("p99"), F.col("q")[2].alias("p9999"))


def region_comparison(rows: DataFrame, region: str, value: str, shown_max: float) -> DataFrame:
    """Per region and for all of them (region null), and what share of values the shown range keeps."""
    kept = 100 * F.avg(F.when(F.col(value) <= shown_max, 1).otherwise(0))
    others = {"n": F.count(value), "mean": F.avg(value), "max": F.max(value), "kept_percent": kept}
    each = percentiles(rows, [region], value, [0.99, 0.999], others)
    whole = percentiles(rows, [], value, [0.99, 0.999], others).withColumn(region, F.lit(None).cast(rows.schema[region].dataType))
    return each.unionByName(whole).select(region, "n", "mean", "max", F.col("q")[0].alias("p99"), F.col("q")[1].alias("p999"), "kept_percent")


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int, keys: list[str]) -> DataFrame:
    """Counts by bin from the left edge; the last bin holds its right edge too."""
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("long")
    return rows.where(F.col(value).between(low, high)).groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))


def stacked_histogram(rows: DataFrame, region: str, value: str) -> DataFrame:
    """Bins from 0 to 1.15 times the maximum, as many as the root of the count but 60 at most. The limits are one row that is broadcast."""
    limits = rows.agg((F.max(value) * 1.15).alias("_high"), F.least(F.lit(60), F.floor(F.sqrt(F.count(value).cast("double")))).alias("_bins"))
    out = rows.crossJoin(F.broadcast(limits))
    b = F.least(F.floor(F.col(value) / (F.col("_high") / F.col("_bins"))), F.col("_bins") - 1).cast("long")
    return out.groupBy(region, b.alias("bin")).agg(F.count("*").alias("n"))


def density_histogram(rows: DataFrame, key: str, value: str, bins: int = 50) -> DataFrame:
    """(key, bin, density) between each key's extremes: two passes, each with partial sums."""
    limits = rows.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("total"))
    width = (F.col("high") - F.col("low")) / bins
    out = rows.join(limits, key).withColumn("bin", F.least(F.floor((F.col(value) - F.col("low")) / width), F.lit(bins - 1)).cast("long"))
    return out.groupBy(key, "bin").agg((F.count("*") / F.first(F.col("total") * width)).alias("density"))


def basic_statistics(rows: DataFrame, value: str, keys: list[str], shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Extremes, mean, deviation and percentiles (median for a half) of groups of any size."""
    others = {"min": F.min(value), "max": F.max(value), "mean": F.avg(value), "std": F.stddev_pop(value)}
    out = percentiles(rows, keys, value, list(shares), others)
    return out.select(*keys, *others, *(F.col("q")[k].alias("median" if q == 0.5 else f"p{round(q * 100)}") for k, q in enumerate(shares)))


def value_counts(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(value).agg(F.count("*").alias("n"))


def ledger_summary(ledger: DataFrame) -> DataFrame:
    extension = F.regexp_extract("s3_destination", r"(\.[^./]+)$", 1)
    return ledger.groupBy("upload_status", extension.alias("extension")).agg(F.count("*").alias("n_files"), F.sum("file_size_bytes").alias("n_bytes"))


def completeness(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """expected (key, expected) against found (key, found): complete, partial or missing."""
    out = expected.join(found, key, "left").withColumn("found", F.coalesce("found", F.lit(0)).cast("long"))
    return out.withColumn("status", F.when(F.col("found") == 0, "missing").when(F.col("found") < F.col("expected"), "partial").otherwise("complete"))


def bounding_box(points: DataFrame, keys: list[str], buffer_percent: float = 10.0) -> DataFrame:
    out = points.groupBy(*keys).agg(*(f(c).alias(f"{c}_{n}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max))))
    for c in ("lon", "lat"):
        pad = (F.col(f"{c}_max") - F.col(f"{c}_min")) * (buffer_percent / 100)
        out = out.withColumns({f"{c}_min": F.col(f"{c}_min") - pad, f"{c}_max": F.col(f"{c}_max") + pad})
    return out


def dateline_shift(points: DataFrame, keys: list[str]) -> DataFrame:
    """Per key whether western longitudes should have 360 added: both signs, a span over 180, and a narrower span after."""
    moved = F.when(F.col("lon") < 0, F.col("lon") + 360).otherwise(F.col("lon"))
    out = points.groupBy(*keys).agg(F.min("lon").alias("lo"), F.max("lon").alias("hi"), (F.max(moved) - F.min(moved)).alias("moved_span"))
    return out.withColumn("shift", (F.col("lo") < 0) & (F.col("hi") > 0) & (F.col("hi") - F.col("lo") > 180) & (F.col("moved_span") < F.col("hi") - F.col("lo")))


def batches_by_name(files: DataFrame) -> DataFrame:
    """files (path, base, start) to the paths of each base in order of their first face."""
    listed = F.array_sort(F.collect_list(F.struct("start", "path")))
    return files.groupBy("base").agg(F.transform(listed, lambda x: x["path"]).alias("paths"))


def layer_count_groups(specs: DataFrame) -> DataFrame:
    """specs (location, sigma_layers): locations by number of layers, the most common number first."""
    out = specs.groupBy("sigma_layers").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("location")), ",").alias("locations"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "sigma_layers")))
