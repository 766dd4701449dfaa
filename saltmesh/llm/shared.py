"""What the training-data operators share: table access and the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch between Spark and a Python task: texts are long, so rows alone would not bound it.
BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a local one only where that is unset (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = new_folder(spark, what)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_made: list[str] = []


def tables_made() -> int:
    """How many tables `stored` has written so far."""
    return len(_made)


def last_made() -> str:
    return _made[-1]


def drop_tables(spark: SparkSession, since: int, keep: Sequence[str] = ()) -> None:
    """Deletes the tables that `stored` wrote since then. Only for tables that nothing reads any more."""
    for path in _made[since:]:
        if path not in keep:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _made[since:] = [p for p in _made[since:] if p in keep]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put in front until df has no column of them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffle files of plans that are no longer referenced."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Characters of text that a Python task cuts into words at once.
SLICE_CHARS = 400_000


def slices(texts: list[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The texts in order (null: empty), in lists of about so many characters, so that memory follows the slice and not the Arrow batch."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1]) + 100
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


_held: list[dict] = []


def keep_only(caches: dict | None = None) -> None:
    """Empties what tasks of other operators left in this Python worker, which Spark uses again, and notes the caches of this one."""
    for other in _held:
        if other is not caches and other:
            other.clear()
            pa.default_memory_pool().release_unused()
    _held[:] = [] if caches is None else [caches]
