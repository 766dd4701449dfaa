"""A running summary of files as they come: each micro-batch is merged into a stored state, which holds mergeable quantile sketches too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import exists

#: Size of a quantile sketch; the share of values below a quantile is then right to about 0.01.
SKETCH = 400
STATE = "n long, total double, high double, low double, sketch binary"


def partials(rows: DataFrame, value: str, key: str = "face") -> DataFrame:
    """(key, n, total, high, low, sketch), which merge by sum, sum, max, min and the union of sketches. Null and NaN values count nothing."""
    x = F.when(~F.isnan(F.col(value)), F.col(value).cast("double"))
    return rows.groupBy(key).agg(F.count(x).alias("n"), F.sum(x).alias("total"), F.max(x).alias("high"), F.min(x).alias("low"), F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias("sketch"))


def merged(parts: DataFrame, key: str = "face") -> DataFrame:
    return parts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("high").alias("high"), F.min("low").alias("low"), F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"))


def summary_of(state: DataFrame, key: str = "face", shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    quantile = lambda q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(f"p{round(q * 100)}")
    return state.select(key, "n", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"), "high", "low", *map(quantile, shares))


def versions(spark: SparkSession, state: str) -> list[int]:
    """Numbers of the batches up to which whole states are stored."""
    if not exists(spark, state):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(state)
    found = [f.getPath() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where) if f.getPath().getName().startswith("upto=")]
    return sorted(int(p.getName().removeprefix("upto=")) for p in found if exists(spark, f"{p}/_SUCCESS"))


def read_state(spark: SparkSession, state: str, schema: str, at_most: int | None = None) -> DataFrame | None:
    """The latest whole state, or the latest up to a batch."""
    known = [v for v in versions(spark, state) if at_most is None or v <= at_most]
    return spark.read.schema(schema).parquet(f"{state}/upto={known[-1]}") if known else None


def add_batch(batch: DataFrame, number: int, state: str, value: str, key: str = "face") -> None:
    """The state up to a batch, from the one before it and the batch. It counts once it is whole; a batch that runs again starts from the state before it, so that no file counts twice. States older than that one go."""
    spark = batch.sparkSession
    parts = partials(batch, value, key)
    before = read_state(spark, state, f"`{key}` {dict(parts.dtypes)[key]}, {STATE}", number - 1)
    new = merged(parts if before is None else before.unionByName(parts), key)
    new.write.mode("overwrite").parquet(f"{state}/upto={number}")
    for old in versions(spark, state):
        if old < number - 1:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/upto={old}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, source: str, schema: str, state: str, checkpoint: str, value: str, key: str = "face", files_per_batch: int = 4) -> DataFrame:
    """Reads the files of source that are new since the last run, and returns the state over all of them: one table, whatever the number of batches."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    keep = lambda batch, number: add_batch(batch, number, state, value, key)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    kind = stream.schema[key].dataType.simpleString()
    found = read_state(spark, state, f"`{key}` {kind}, {STATE}")
    return spark.createDataFrame([], f"`{key}` {kind}, {STATE}") if found is None else found
