"""Repeated bytes: ids that repeat, are null or are no numbers, long texts, and clashing columns."""

import random

from pyspark.sql import functions as F

from agrispark.llm import rindex
from test_llm import repeats_brute


def results(df):
    out = rindex.without_repeats(df)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h"))


def text(n, seed):
    return "".join(random.Random(seed).choices("abcdefghij klmn", k=n))


def test_ids_that_repeat_or_are_null(spark):
    shared = text(300, 1)
    rows = [(1, text(300, 2)), (2, shared), (2, text(300, 3)), (3, "x" + shared), (None, text(250, 4)), (None, text(250, 5)), (None, None), (7, shared), (7, shared)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as doc", "2 as chunk", "3 as kept")
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in results(docs).collect()}
    assert got == {(1, 300, 0), (2, 300, 0), (3, 301, 300), (None, 250, 0), (None, 0, 0), (7, 300, 300)}


def test_long_texts_equal_brute_force(spark):
    passage = text(700, 6)
    texts = [text(60_000, 7), text(3000, 8) + passage + text(30_000, 9) + passage, passage, "ab" * 20_000, "", text(60_000, 7)[500:900]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [tuple(r)[1:] for r in sorted(results(docs).collect())] == repeats_brute(texts)


def test_ids_that_are_no_numbers(spark):
    shared = text(300, 1)
    docs = spark.createDataFrame([("a", shared), ("b", shared), ("c", text(200, 2))], "doc_id string, text string")
    assert sorted(r.n_removed for r in results(docs).collect()) == [0, 0, 300]
