"""Rings of boundary edges by list ranking, and convex hulls by partial hulls: no group holds a whole boundary or set."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .time_checks import assert_valid

#: Parts over which the partial hulls of a key are dealt, and points that a task holds before it reduces them.
SLOTS, HELD = 32, 100_000


def _successors(edges: DataFrame, key: str) -> DataFrame:
    """(key, a, b, c): each edge in both directions, with the node after it. At a node the neighbours are paired in order, the first with the second, the third with the fourth, so that rings may touch."""
    e = edges.where("a <> b").select(F.col(key).alias("k"), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = e.unionByName(e.select("k", F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("k", "b").agg(F.array_sort(F.collect_list("a")).alias("near"))
    assert_valid(near.where(F.size("near") % 2 == 1).select(F.col("k").alias(key), F.col("b").alias("node"), F.lit("the boundary is open here").alias("problem")))
    paired = near.select("k", "b", "near", F.posexplode("near").alias("p", "a"))
    return paired.select("k", "a", "b", F.element_at("near", F.col("p").bitwiseXOR(F.lit(1)) + 1).alias("c"))


def ring_of_edges(edges: DataFrame, key: str = "location") -> DataFrame:
    """(key, ring, pos, node) of boundary edges (key, a, b), whose nodes have two or another even number of edges: each ring from its smallest node on towards the smaller neighbour, rings in the order of their first nodes. Repeated edges are one; null keys are a group of their own.

    By pointer doubling: every edge knows the edge 2^n places on and the least edge up to there, with the way to it; a self-join doubles the reach. When no edge finds a smaller one, all know the first edge of their ring and how far it is, which is the rank. The rounds are as many as the logarithm of the longest ring."""
    first = _successors(edges.where(F.col(key).isNotNull()), key)
    if not edges.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} is null")
    state = kept(first.select("k", "a", "b", F.struct(F.col("b").alias("a"), F.col("c").alias("b")).alias("jump"), F.struct("a", "b").alias("least"), F.lit(0).cast("long").alias("way")), "ring")
    reach = 1
    while True:
        other = state.select("k", F.struct("a", "b").alias("jump"), F.col("jump").alias("_jump"), F.col("least").alias("_least"), F.col("way").alias("_way"))
        lower = F.col("_least") < F.col("least")
        state = kept(
            state.join(other, ["k", "jump"]).select(
                "k", "a", "b", F.col("_jump").alias("jump"), F.least("least", "_least").alias("least"), F.when(lower, F.col("_way") + reach).otherwise(F.col("way")).alias("way"), (F.col("_least") != F.col("least")).alias("changed")
            ),
            "ring",
        )
        if state.where("changed").isEmpty():
            break
        state, reach = state.drop("changed"), 2 * reach
    # Each ring was ranked in both directions; the one whose first edge is smaller stays.
    ends = [F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b")]
    one = state.groupBy("k", *ends).agg(F.min(F.struct("least", "a", "way")).alias("m")).select("k", "m.*")
    rings = one.groupBy("k", "least").agg(F.count("*").alias("n"))
    rings = rings.withColumn("ring", F.row_number().over(Window.partitionBy("k").orderBy("least")) - 1)
    out = one.join(rings, ["k", "least"])
    return out.select(F.col("k").alias(key), F.col("ring").cast("int"), F.pmod(-F.col("way"), F.col("n")).cast("int").alias("pos"), F.col("a").cast("long").alias("node"))


def _hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the hull, counter-clockwise from the smallest point."""
    pts = sorted(set(points))
    turn = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    sides = []
    for line in (pts, pts[::-1]):
        side: list[tuple] = []
        for p in line:
            while len(side) > 1 and turn(side[-2], side[-1], p) <= 0:
                side.pop()
            side.append(p)
        sides.append(side[:-1] if len(side) > 1 else side)
    return sides[0] + (sides[1] if len(pts) > 1 else [])


def convex_hull(points: DataFrame, key: str) -> DataFrame:
    """(key, pos, lon, lat) of the hull of the points of each key, counter-clockwise. Points without a place are left out. Every task reduces its points to hulls, parts of a key reduce those, and the last step sees the corners of few hulls."""
    kind = dict(points.dtypes)[key]
    rows = points.select(F.col(key).alias("k"), F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat")).where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")

    def reduced(held: pd.DataFrame) -> pd.DataFrame:
        out = [(k, x, y) for k, part in held.groupby("k", dropna=False, sort=False) for x, y in _hull(list(zip(part["lon"], part["lat"], strict=True)))]
        return pd.DataFrame(out, columns=["k", "lon", "lat"]).astype({"k": held["k"].dtype})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(reduced(batch))
            if sum(map(len, held)) > HELD:
                held = [reduced(pd.concat(held))]
                if len(held[0]) > HELD / 2:  # many keys, or hulls with many corners
                    yield held.pop()
        if held:
            yield reduced(pd.concat(held))

    def part(own: pd.DataFrame) -> pd.DataFrame:
        return reduced(own.drop(columns="slot"))

    def last(own: pd.DataFrame) -> pd.DataFrame:
        out = reduced(own)
        return pd.DataFrame({key: out["k"], "pos": range(len(out)), "lon": out["lon"], "lat": out["lat"]})

    schema = f"k {kind}, lon double, lat double"
    found = rows.mapInPandas(partial, schema)
    found = found.withColumn("slot", F.pmod(F.xxhash64("lon", "lat"), F.lit(SLOTS))).groupBy("k", "slot").applyInPandas(part, schema)
    return found.groupBy("k").applyInPandas(last, f"`{key}` {kind}, pos int, lon double, lat double")


def outline(at: DataFrame, keys: list[str], x: Column, y: Column) -> DataFrame:
    """(keys, wkt, bounds) of ring places (keys, pos, x, y): the one value that holds a whole ring."""
    listed = F.array_sort(F.collect_list(F.struct("pos", x.alias("x"), y.alias("y"))))
    text = F.transform(listed, lambda p: F.format_string("%.6f %.6f", p["x"], p["y"]))
    out = at.groupBy(*keys).agg(text.alias("t"), F.min(x).alias("lon_min"), F.max(x).alias("lon_max"), F.min(y).alias("lat_min"), F.max(y).alias("lat_max"))
    return out.select(*keys, F.concat(F.lit("POLYGON (("), F.array_join(F.concat("t", F.slice("t", 1, 1)), ", "), F.lit("))")).alias("wkt"), "lon_min", "lon_max", "lat_min", "lat_max")
