"""The stages of the pipeline tell rows apart by more than their id, which may be null or repeated."""

import pytest
from pyspark.sql import functions as F

from agrispark.llm import decontam, ngram_join, quality
from agrispark.llm.common import row_key

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LEAK = "which of the rivers named below runs through seven capitals before it meets the sea"


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], SCHEMA)


def text(k, n=30):
    return " ".join(f"w{k}x{j}" for j in range(n))


def test_null_and_repeated_ids_lose_near_copies_only(spark):
    pairs = [(None, text(k)) for k in range(4)] + [(7, text(5)), (7, text(6)), (None, None), (7, "")]
    copies = [(3, text(0) + " tail"), (9, text(5) + " tail"), (None, text(1) + " tail"), (7, text(6))]
    kept = sorted(map(str, ([r.doc_id, r.text] for r in ngram_join.one_of_each(rows(spark, pairs + copies)).collect())))
    of_two = [p for p in kept if text(1) in p]
    want = [p for p in pairs if p[1] not in (text(0), text(1))] + [(3, text(0) + " tail")]
    assert sorted(set(kept) - set(of_two)) == sorted(str(list(p)) for p in want)
    assert len(of_two) == 1 and len(kept) == len(want) + 1


@pytest.mark.parametrize("i", [None, 4])
def test_leak_goes_alone(spark, i):
    benchmark = spark.createDataFrame([("b", LEAK)], "item_id string, text string")
    docs = rows(spark, [(i, "so " + LEAK + " and on"), (i, text(1)), (i, text(2)), (i, None)])
    assert {r.text for r in decontam.without_leaks(docs, benchmark).collect()} == {text(1), text(2), None}


@pytest.mark.parametrize("i", [None, 4])
def test_rejected_row_goes_alone(spark, monkeypatch, i):
    bad = F.col("text").contains("bad")

    def judged(docs, labels, host, path, id_col, text_col, key_col="doc_id"):
        return docs.select(F.col(key_col).alias("_id"), F.coalesce(~bad, F.lit(True)).alias("keep"))

    monkeypatch.setattr(quality, "classified", judged)
    docs = rows(spark, [(i, "bad text"), (i, text(1)), (i, None)])
    assert {r.text for r in quality.keep_good(docs, None).collect()} == {text(1), None}


def test_row_keys_tell_nulls_apart(spark):
    docs = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert docs.select(row_key(docs)).distinct().count() == 4


def test_mix_of_null_ids_and_clashing_columns(spark):
    from agrispark.llm import mixing

    rows = [(None if i % 3 else i, "w " * (i % 40), "s" if i % 2 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as key", "2 as shard", "3 as target", "4 as size")
    got = mixing.mix(docs, shard_words=200).collect()
    assert len(got) == 300 and all(0 <= r.taken <= 2 * r.size for r in got)
    for source in ("s", None):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64 + 32 * (1 + own[0].source_size // 200)
