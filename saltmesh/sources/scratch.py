"""The folder that driver and executors share, and tables kept in it between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder in spark.checkpoint.dir. Where that is unset, as in tests, it is set once, to a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def kept(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back: what follows neither repeats its work nor depends on the executors that did it."""
    folder = scratch(df.sparkSession, what)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows of a table that may be broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, with a hint to broadcast it if it was counted to have few rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def exists(spark: SparkSession, folder: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
