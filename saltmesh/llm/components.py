"""Connected components of links, as Spark jobs: the smallest label spreads over links and along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of links (a, b); component is the smallest id that links reach. Each round is a stored table; a round halves long chains by following labels to their own labels."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        spread = labels.join(near, labels.id == near.a).select("id", "component", F.least("component", "near").alias("low"))
        own = labels.select(F.col("id").alias("low"), F.col("component").alias("lower"))
        new = stored(spread.join(own, "low").select("id", F.col("lower").alias("component"), (F.col("lower") != F.col("component")).alias("changed")), "labels")
        labels = new.select("id", "component")
        if new.where("changed").isEmpty():
            return labels
