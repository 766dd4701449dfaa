"""Exact percentiles of groups of any size, without a buffer of a group's values.

A bounded sketch of each group brackets every wanted rank; a second pass counts what lies below a bracket and gathers the
distinct values inside it with their counts, a few thousandths of the group. Those are put in order by ranges, sums over the
ranges before tell which range holds a rank, and only that range is looked through. So no task holds more than a sketch, its
own partial counts or one range, however large the group and however often a value repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: A sketch is right to one part in so many of a group; groups of at most so many values need no bracket.
ACCURACY = 10_000
#: Groups that are broadcast, and distinct values that are put in order without ranges.
BROADCAST_GROUPS, FEW_VALUES = 100_000, 200_000


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str], how: str, few: bool) -> DataFrame:
    """rows with the columns of groups, null keys being equal. Without keys groups is one row."""
    own = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    own = F.broadcast(own) if few else own
    if not keys:
        return rows.crossJoin(own)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return rows.join(own, on, how).drop(*(f"_g_{k}" for k in keys))


def percentiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], others: dict[str, Column] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """(keys, others, q): q has the interpolated percentile of value for each share; others are aggregates of the first pass. NaN counts as null; a group without values has null percentiles; null keys are a group."""
    data = rows.withColumn(value, F.col(value).cast("double")).withColumn(value, F.when(~F.isnan(value), F.col(value)))
    slack = 4 / accuracy
    marks = [F.lit(float(min(max(q + s, 0.0), 1.0))) for s in (-slack, slack) for q in shares]
    sketch = F.percentile_approx(value, F.array(*marks), F.lit(accuracy))
    groups = data.groupBy(*keys).agg(F.count(value).alias("_n"), sketch.alias("_marks"), *(c.alias(n) for n, c in (others or {}).items()))
    groups = kept(groups, "groups")
    few = groups.count() <= BROADCAST_GROUPS

    bounds = groups.where("_n > 0").select(*keys, "_marks", (F.col("_n") > accuracy).alias("_many"))
    met = _joined(data.select(*keys, F.col(value).alias("_x")).where("_x is not null"), bounds, keys, "inner", few)
    low = [~F.col("_many") | (F.col("_x") >= F.col("_marks")[j]) for j in range(len(shares))]
    high = [~F.col("_many") | (F.col("_x") <= F.col("_marks")[len(shares) + j]) for j in range(len(shares))]
    # Below a bracket only the number matters: those rows are one, with a null for their value.
    part = F.array_compact(F.array(*(F.when(high[j], F.struct(F.lit(j).alias("_j"), F.when(low[j], F.col("_x")).alias("_v"))) for j in range(len(shares)))))
    counts = met.select(*keys, F.explode(part).alias("_p")).groupBy(*keys, "_p._j", "_p._v").agg(F.count("*").alias("_c"))
    counts = kept(counts, "values")
    target = [*keys, "_j"]
    order = [*(F.col(k).asc_nulls_first() for k in target), F.col("_v").asc_nulls_first()]
    share = F.element_at(F.array(*(F.lit(float(q)) for q in shares)), F.col("_j") + 1)
    own = [*target]
    if counts.count() <= FEW_VALUES:
        held = _joined(counts, groups.select(*keys, "_n"), keys, "inner", few).withColumns({"_at": (F.col("_n") - 1) * share, "_before": F.lit(0)})
        held = held.withColumns({"_lo": F.floor("_at"), "_hi": F.ceil("_at")})
    else:
        own.append("_range")
        ranged = kept(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
        before = Window.partitionBy(*target).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        sizes = ranged.groupBy(*own).agg(F.sum("_c").alias("_size")).withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        wanted = _joined(sizes, groups.select(*keys, "_n"), keys, "inner", few).withColumn("_at", (F.col("_n") - 1) * share)
        wanted = wanted.withColumns({"_lo": F.floor("_at"), "_hi": F.ceil("_at")})
        # At most the ranges of the two ranks go on.
        wanted = wanted.where((F.col("_before") <= F.col("_hi")) & (F.col("_lo") < F.col("_before") + F.col("_size")))
        held = _joined(ranged, wanted, own, "inner", few)
    upto = Window.partitionBy(*own).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = held.withColumn("_end", F.col("_before") + F.sum("_c").over(upto))
    at = lambda rank: F.max(F.when((F.col(rank) < F.col("_end")) & (F.col(rank) >= F.col("_end") - F.col("_c")), F.col("_v")))
    found = placed.groupBy(*target).agg(at("_lo").alias("_a"), at("_hi").alias("_b"), F.first("_at").alias("_at"))
    # A bracket that misses its rank would be a fault of the sketch.
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))
    found = found.select(*target, F.coalesce(between, F.raise_error(F.lit("a bracket misses its rank")).cast("double")).alias("_q"))
    lists = found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", "_q"))), lambda s: s["_q"]).alias("_q"))
    if not keys:
        lists = lists.select(F.when(F.size("_q") > 0, F.col("_q")).alias("_q"))
    out = _joined(groups, lists, keys, "left", few)
    return out.select(*keys, *(others or {}), F.col("_q").alias("q"))
