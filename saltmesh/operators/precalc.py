"""The table of precalculated constants of faces: columns that are missing or stale are computed, the rest is carried over."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .time_checks import InvalidData

#: A column's maker gets the table so far (face, lat, lon and the columns it needs) and returns (face, column).
Maker = Callable[[DataFrame], DataFrame]


def outdated(faces: DataFrame, existing: DataFrame | None, needs: dict[str, tuple[str, ...]], stale: Iterable[str] = (), tolerance: float = 1e-6) -> list[str]:
    """Columns to compute, in the order of needs: those that existing lacks, that are null for some face, that are named stale, and all that need one of these. All of them if existing has other faces, a face twice, or other places."""
    if existing is None or not {"face", "lat", "lon"} <= set(existing.columns):
        return list(needs)
    far = lambda c: F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) > 1e-8 + tolerance * F.abs(F.col(c)), F.lit(True))
    own = [c for c in needs if c in existing.columns]
    mine = existing.groupBy("face").agg(F.count("*").alias("_n"), F.min("lat").alias("_lat"), F.min("lon").alias("_lon"), *(F.count(c).alias(f"_has_{c}") for c in own))
    both = faces.select("face", "lat", "lon").join(mine, "face", "full")
    off = both.agg(
        F.coalesce(F.bool_or(far("lat") | far("lon") | (F.coalesce("_n", F.lit(0)) != 1)), F.lit(False)).alias("other"), *(F.coalesce(F.bool_or(F.coalesce(f"_has_{c}", F.lit(0)) == 0), F.lit(False)).alias(c) for c in own)
    ).collect()[0]
    if off["other"]:
        return list(needs)
    out: list[str] = []
    for c, before in needs.items():
        if c not in own or c in stale or off[c] or any(b in out for b in before):
            out.append(c)
    return out


def precalculated(faces: DataFrame, makers: dict[str, Maker], needs: dict[str, tuple[str, ...]] | None = None, existing: DataFrame | None = None, stale: Iterable[str] = ()) -> tuple[DataFrame, list[str]]:
    """faces (face, lat, lon) with a column for each maker, and which of them were computed now. Each is stored before the next, so that a run that breaks off has them; a maker that leaves a face out gives null there."""
    needs = {c: (needs or {}).get(c, ()) for c in makers}
    for k, c in enumerate(needs):
        if not set(needs[c]) <= set(list(needs)[:k]):
            raise InvalidData(f"{c} comes before what it needs: {', '.join(needs[c])}")
    todo = outdated(faces, existing, needs, stale)
    carried = [c for c in needs if c not in todo]
    table = faces.select("face", "lat", "lon")
    if carried:
        table = table.join(existing.select("face", *carried), "face", "left")
    for c in needs:
        if c in todo:
            table = kept(table.join(makers[c](table).select("face", c), "face", "left"), c)
    return table.select("face", "lat", "lon", *needs), todo
