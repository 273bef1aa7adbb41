"""The n-gram join leaves on disk only what it still reads."""

import os
import re
import time

import numpy as np
from pyspark.sql import functions as F

from agrispark.llm import ngram_join
from agrispark.llm.common import FREED, table, written

SF = "/root/testdata/sf0.001"


def tables_of(spark) -> set[str]:
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")))


def shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def test_shuffle_files_go_with_the_query(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREED)
    out = written(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    late = time.time() + 20  # Spark deletes them in the background
    while shuffle_files(spark) - before and time.time() < late:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and out.count() == 7
    assert spark.conf.get(FREED) == setting


def test_tables_that_are_replaced_go(spark):
    before = tables_of(spark)
    out = ngram_join.jaccard_components(table(spark, SF, "documents"), 4, 85, 100)
    assert out.count() == 200
    names = {re.sub(r"-[0-9a-f]{32}$", "", t) for t in tables_of(spark) - before}
    assert {"members", "nodes"} <= names and not names & {"hashed", "entries", "chosen", "sets", "unsettled"}


def test_sieve_holds_all_chosen_rows_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIECE", 1 << 10)
    chosen = spark.range(1000).select(F.xxhash64("id").alias("_row"))
    held = ngram_join.sieve(chosen)
    assert 8 * len(held) == 1 << 14  # sixteen pieces

    def passed(df):
        at = np.array([r[0] for r in df.collect()]) & (8 * len(held) - 1)
        return int((held[at >> 3] >> (7 - (at & 7)) & 1).sum())

    assert passed(chosen) == 1000 and passed(spark.range(1000, 11_000).select(F.xxhash64("id"))) < 1000
    assert not ngram_join.sieve(chosen.limit(0)).any()


def test_sets_are_of_the_chosen_rows(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.md5(F.concat("id", F.lit(f" {i}"))) for i in range(9))).alias("text"))
    nodes = docs.select(ngram_join.row_of("doc_id", "text").alias("_row"), F.col("doc_id").alias("key"))
    sets = ngram_join.sets_for(spark.range(5).select(F.col("id").alias("key")), nodes, docs, 4, np.empty(0, np.uint64), "doc_id", "text")
    assert sorted((r.key, len(r.set) // 8) for r in sets.collect()) == [(i, 6) for i in range(5)]


def test_frequent_shingles_are_those_of_32_documents_whatever_the_input(spark):
    texts = ["one two three four"] * 40 + ["five six seven eight"] * 100 + [f"a{i} b{i} c{i} d{i}" for i in range(200_000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = ngram_join.hashed(docs, 4, 85, 100, 8, "doc_id", "text").where("bucket is not null")
    assert sorted(ngram_join.often_shingles(made)[1]) == [40, 100]  # by share, 50 documents would be needed
    assert list(ngram_join.often_shingles(made, most=1)[1]) == [100]
