"""Intermediate tables, and which tables are small enough to broadcast."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most so many rows is broadcast; a larger one is joined by shuffle.
MOST_BROADCAST = 100_000
#: Estimated bytes of a table that one task sorts.
BYTES_A_TASK = 2 << 20
MOST_TASKS = 10_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, a temporary folder in local mode, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="agrispark-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read back, so that loops and counts don't compute it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables that ``kept`` wrote and no plan reads any more."""
    for df in tables:
        for f in df.inputFiles()[:1]:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(dimension: DataFrame) -> DataFrame:
    """The table, marked for broadcast if its count allows it."""
    return F.broadcast(dimension) if dimension.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else dimension


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by keys over a number of tasks in proportion to its estimated size, so that sorts by key don't grow with the input.

    The estimate is the optimizer's, from the sizes of the files read. Left to itself Spark joins partitions up to a size
    of compressed bytes, whose rows take many times that in memory. Where only few keys are so large, tasks still spill.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / BYTES_A_TASK))
    return df.repartition(min(tasks, MOST_TASKS), *keys)
