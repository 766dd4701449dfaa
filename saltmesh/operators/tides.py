"""Flood and ebb, peaks of the tide, tidal levels and periods."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Least prominence of a peak in m, bins of directions in degrees, and the speed from which water counts as moving.
PROMINENCE, BIN_DEGREES, MOVING = 0.05, 2.0, 0.5


def gradient(value: str, keys: list[str], order: str = "t") -> Column:
    """Central difference per step, one-sided at the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.coalesce((after - before) / 2, after - here, here - before)


def tide_phase(surface: DataFrame, keys: list[str], value: str = "zeta_center") -> DataFrame:
    """surface with phase flood, ebb or null. The gradient is rounded first, so that noise does not turn slack water."""
    out = surface.withColumn("gradient", F.round(gradient(value, keys), 9))
    return out.withColumn("phase", F.when(F.col("gradient") > 0, "flood").when(F.col("gradient") < 0, "ebb"))


def direction_modes(flow: DataFrame, keys: list[str], bin_degrees: float = BIN_DEGREES, moving: float = MOVING, step_hours: float = 1.0) -> DataFrame:
    """For each key the fullest direction bin (its left edge; ties to the lowest), the mean speed in it and the hours of moving water. Counts by bin are combined before the shuffle."""
    n = int(360 / bin_degrees)
    b = F.least(F.floor(F.col("to_direction") / bin_degrees), F.lit(n - 1)).cast("long")
    rows = flow.where("to_direction is not null").withColumn("bin", b)
    bins = rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.avg("speed").alias("mean_speed"), F.sum(F.when(F.col("speed") >= moving, F.lit(step_hours)).otherwise(F.lit(0.0))).alias("hours"))
    first = Window.partitionBy(*keys).orderBy(F.desc("n"), "bin")
    total = F.sum("hours").over(Window.partitionBy(*keys))
    out = bins.withColumn("moving_hours", total).withColumn("rank", F.row_number().over(first)).where("rank = 1")
    return out.select(*keys, (F.col("bin") * bin_degrees).alias("direction"), "mean_speed", "n", "moving_hours")


def angular_difference(a: Column, b: Column) -> Column:
    d = F.abs(a - b)
    return F.least(d, 360 - d)


def primary_and_secondary(flow: DataFrame, keys: list[str], bin_degrees: float = BIN_DEGREES, mask_degrees: float = 180.0) -> DataFrame:
    """The fullest bin of each key, and the fullest among those over half the mask away from it."""
    n = int(360 / bin_degrees)
    b = F.least(F.floor(F.col("to_direction") / bin_degrees), F.lit(n - 1)).cast("long")
    bins = flow.where("to_direction is not null").groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.asc("bin")]
    top = F.first("bin").over(Window.partitionBy(*keys).orderBy(*order))
    bins = bins.withColumn("primary_direction", top * bin_degrees).withColumn("d", F.col("bin") * bin_degrees)
    away = bins.withColumn("far", angular_difference(F.col("d"), F.col("primary_direction")) > mask_degrees / 2)
    second = F.row_number().over(Window.partitionBy(*keys, "far").orderBy(*order))
    best = away.withColumn("rank", second).where("rank = 1")
    return best.groupBy(*keys).agg(F.first("primary_direction").alias("primary_direction"), F.max(F.when(F.col("far"), F.col("d"))).alias("secondary_direction"))


def mean_direction(angle: Column, circular: bool = True) -> Column:
    """Mean of directions over a group: on the circle, or of the numbers."""
    if not circular:
        return F.avg(angle)
    a = F.radians(angle)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))), F.lit(360.0))


def _bases(level: np.ndarray) -> np.ndarray:
    """For each value the least value since the last higher one (or the start), itself included, in one pass with a stack."""
    out = level.copy()
    stack: list[tuple[float, float]] = []
    for k, x in enumerate(level.tolist()):
        low = x
        while stack and stack[-1][0] <= x:
            low = min(low, stack.pop()[1])
        out[k] = low
        stack.append((x, low))
    return out


def find_peaks(x: np.ndarray, prominence: float = PROMINENCE) -> np.ndarray:
    """Places of local maxima (the middle of a plateau, never an end) that stand out by prominence at least."""
    n = len(x)
    if n < 3:
        return np.empty(0, np.int64)
    head = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    tail = np.r_[head[1:] - 1, n - 1]
    level = x[head]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    base = np.maximum(_bases(level), _bases(level[::-1])[::-1])[top]
    top = top[level[top] - base >= prominence]
    return (head[top] + tail[top]) // 2


PEAKS = (
    "face long, t long, time timestamp_ntz, level double, is_high boolean, is_peak boolean, next_high timestamp_ntz, low double, low_time timestamp_ntz, "
    "mean_level double, mean_left double, top double, bottom double"
)


def peaks(surface: DataFrame, prominence: float = PROMINENCE, share: float = 0.2) -> DataFrame:
    """surface (face, t, time, zeta_center) to its high and low tides, see PEAKS, in one pass over each face. A group is one face's year, some 17,000 rows.

    A high tide has the time of the next one and the lowest low tide between. A face without peaks on either side also
    gets its highest and lowest share of levels, with is_peak false. mean_level is the face's mean, mean_left what is
    left of the mean after it is taken off, top and bottom are the extremes.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("t")
        z = part["zeta_center"].to_numpy()
        high, low = find_peaks(z, prominence), find_peaks(-z, prominence)
        following = np.append(high[1:], -1)[: len(high)]
        between = [low[(low > a) & (low < b)] for a, b in zip(high, following, strict=True)] if len(low) else [low] * len(high)
        least = [b[np.argmin(z[b])] if len(b) else -1 for b in between]
        # Places of low tides, of high ones and, without peaks on either side, of the highest and lowest share.
        at, sides, n_peaks = [low, high], [False, True], len(low) + len(high)
        if not len(high) or not len(low):
            k = max(1, int(len(z) * share))
            order = np.argsort(z, kind="stable")
            at, sides = [*at, order[-k:], order[:k]], [*sides, True, False]
        where, n = np.concatenate(at).astype(np.int64), sum(map(len, at))
        of_high = lambda values: np.concatenate([np.full(len(low), -1), values, np.full(n - n_peaks, -1)]).astype(np.int64)
        following, least = of_high(following), of_high(least)
        times = part["time"].to_numpy()
        pick = lambda values, k, none: np.where(k >= 0, values[np.maximum(k, 0)], none)
        never = np.array("NaT", times.dtype)
        return pd.DataFrame({
            "face": np.full(n, part["face"].iloc[0]), "t": part["t"].to_numpy()[where], "time": times[where], "level": z[where], "is_high": np.repeat(sides, [len(x) for x in at]), "is_peak": np.arange(n) < n_peaks,
            "next_high": pick(times, following, never), "low": pick(z, least, np.nan), "low_time": pick(times, least, never), "mean_level": z.mean(), "mean_left": (z - z.mean()).mean(), "top": z.max(), "bottom": z.min(),
        })

    rows = surface.select("face", "t", "time", "zeta_center").where("zeta_center is not null and not isnan(zeta_center)")
    # Faces are work rather than bytes: a number of partitions that is given isn't made smaller for being light.
    n = int(surface.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "face").groupBy("face").applyInPandas(run, PEAKS)


LEVELS = ("max_high", "min_high", "mean_high", "max_low", "mean_low", "min_low")
KINDS = {"Twice Daily Tides": (10, 14), "Once Daily Tides": (20, 26)}


def _level_columns() -> dict[str, Column]:
    """Aggregates of PEAKS by face: levels over the mean, from peaks if there are some on both sides, else from the shares of all levels."""
    spare = F.max((~F.col("is_peak")).cast("int")) == 1
    over = F.col("level") - F.col("mean_level")
    out = {}
    for name in LEVELS:
        how = {"max": F.max, "min": F.min, "mean": F.avg}[name.split("_")[0]]
        side = F.col("is_high") if name.endswith("high") else ~F.col("is_high")
        out[name] = F.when(spare, how(F.when(side & ~F.col("is_peak"), over))).otherwise(how(F.when(side & F.col("is_peak"), over)))
    out["method"] = F.when(spare, "top_share").otherwise("peaks")
    return out | {"msl_offset": F.first("mean_level"), "mean_water": F.first("mean_left"), "range_extremes": F.first("top") - F.first("bottom")}


def _period_columns() -> dict[str, Column]:
    """Aggregates of PEAKS by face: the accepted times between high tides, and the ranges of all cycles with a low tide."""
    hours = (F.unix_micros(F.col("next_high").cast("timestamp")) - F.unix_micros(F.col("time").cast("timestamp"))) / 3.6e9
    accepted = F.when(F.expr("false"), hours)
    for low, high in KINDS.values():
        accepted = accepted.when((hours > low) & (hours < high), hours)
    spread = F.col("level") - F.col("low")
    return {
        "n_periods": F.count(accepted), "mean_period": F.avg(accepted), "min_period": F.min(accepted), "max_period": F.max(accepted),
        "n_cycles": F.count("low"), "mean_range": F.avg(spread), "min_range": F.min(spread), "max_range": F.max(spread),
    }


def _finished(report: DataFrame, levels: bool, periods: bool) -> DataFrame:
    names = ["face"]
    if levels:
        report = report.withColumn("range_peaks", F.col("max_high") - F.col("min_low"))
        names += [*LEVELS, "range_peaks", "range_extremes", "msl_offset", "mean_water", "method"]
    if periods:
        known = F.col("n_periods") > 0
        kind = F.lit("Unknown")
        for name, (low, high) in KINDS.items():
            kind = F.when(known & (F.col("mean_period") > low) & (F.col("mean_period") < high), name).otherwise(kind)
        report = report.withColumn("type", F.when(known & (kind == "Unknown"), "Mixed Pattern Tides").otherwise(kind))
        shown = ["mean_period", "min_period", "max_period", "mean_range", "min_range", "max_range"]
        report = report.withColumns({c: F.when(known, F.coalesce(c, F.lit(0.0))).otherwise(0.0) for c in shown})
        names += ["n_periods", "n_cycles", *shown, "type"]
    return report.select(*names)


def _by_face(peak_rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return peak_rows.groupBy("face").agg(*(c.alias(n) for n, c in columns.items()))


def tidal_levels(peak_rows: DataFrame) -> DataFrame:
    """Highest, mean and lowest high and low water of each face over its mean level, both ranges, the offset of the mean level and the method. Without peaks on both sides, both come from the top and bottom share of the levels."""
    return _finished(_by_face(peak_rows, _level_columns()), True, False)


def level_warnings(levels: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """levels with an array of what is odd about them."""
    rules = [(F.col("range_peaks") < 0.1, "range under 0.1 m"), (F.col("range_peaks") > 15, "range over 15 m"), (F.col("mean_high") <= F.col("mean_low"), "mean high water not over mean low water"), (F.abs("mean_water") > tolerance, "mean sea level off")]
    return levels.withColumn("warnings", F.array_compact(F.array(*(F.when(c, F.lit(w)) for c, w in rules))))


def tidal_cycles(peak_rows: DataFrame) -> DataFrame:
    """High tides with the lowest low tide before the next one: range, and hours until the next one."""
    hours = (F.unix_micros(F.col("next_high").cast("timestamp")) - F.unix_micros(F.col("time").cast("timestamp"))) / 3.6e9
    rows = peak_rows.where("is_peak and is_high and low is not null")
    return rows.select("face", "t", "time", F.col("level").alias("high"), "low", "low_time", (F.col("level") - F.col("low")).alias("range"), hours.alias("period_hours"))


def tidal_periods(peak_rows: DataFrame) -> DataFrame:
    """Of each face: number, mean, shortest and longest of the times between high tides within KINDS (bounds left out), in hours; number and ranges of all cycles with a low tide; the kind of the mean period. Without an accepted period all are 0, the kind unknown."""
    return _finished(_by_face(peak_rows, _period_columns()), False, True)


def surface_report(peak_rows: DataFrame) -> DataFrame:
    """Levels and periods of each face, from one pass over its peaks."""
    return _finished(_by_face(peak_rows, _level_columns() | _period_columns()), True, True)
