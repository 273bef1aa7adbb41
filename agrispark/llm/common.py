"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Whether Spark deletes the shuffle files of a query as soon as it ends, in place of when the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, a temporary folder in local mode, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="agrispark-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside are deleted when each of them ends."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to shared storage and read back, which cuts its lineage; its shuffle files go."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` made and nobody reads any more."""
    for df in tables:
        for f in df.inputFiles()[:1]:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(docs: DataFrame) -> Column:
    """64 bits of a row's columns and of which are null: rows that differ have keys of their own, also under one id or none."""
    return F.xxhash64(*(F.col(f"`{c}`").isNull() for c in docs.columns), *(F.col(f"`{c}`") for c in docs.columns))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    parts = F.split(text, GAP)
    ends = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return F.coalesce(F.size(parts) - ends, F.lit(0)).cast("long")


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes.split`` and ``bytes.lower`` touch ASCII only."""
    return text.lower().split()


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, each computed once for a batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that work arrays stay small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def mapped(df: DataFrame, function: Callable, schema: str, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` of a function from a small record batch to record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows):
            yield from function(batch)

    return df.mapInArrow(run, schema)


def mixed64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node that an edge names; the component is its smallest node.

    Alternating large-star and small-star rounds over the edge table: each round is two grouped minima and
    two joins, so hubs are split like any skewed join, and the number of rounds grows with the logarithm of
    the longest chain. Every round is written to shared storage.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc"
    )

    def star(e: DataFrame, large: bool) -> DataFrame:
        sides = e.select("u", "v")
        if large:
            sides = sides.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = sides.join(least, "u")
        if large:
            out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())

    seen = mark(now)
    while seen[0]:
        nxt = written(star(star(now, True), False), "cc")
        dropped(now)
        now, found = nxt, mark(nxt)
        if found == seen:
            break
        seen = found
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )
