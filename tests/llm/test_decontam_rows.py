"""Decontamination: repeated rows and ids, rows without ids, long texts, clashing columns, and recall of the index."""

import random

from pyspark.sql import functions as F

from agrispark.llm import decontam

WORDS = [f"v{i}" for i in range(3000)]


def some(n, seed):
    return random.Random(seed).sample(WORDS, n)


def test_rows_ids_and_columns(spark):
    item = " ".join(some(40, 1))
    bench = spark.createDataFrame([(5, item), (5, item), (None, " ".join(some(30, 2))), (6, None)], "item_id bigint, text string")
    leak = "before " + item + " after"
    rows = [(1, leak), (1, leak), (1, "another text of the same id"), (None, leak), (2, "clean"), (3, " ".join(some(30, 2))), (4, " ".join(random.Random(4).choices(WORDS, k=30000)) + " " + item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'x' as id", "1 as row", "2 as n", "3 as s", "4 as i")
    got = {(r.doc_id, r.item_id, r.start) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(1, 5, 1), (None, 5, 1), (3, None, 0), (4, 5, 30000)}
    assert sorted(r.text[:7] for r in decontam.without_leaks(docs, bench).collect()) == ["another", "clean"]


def test_recall_of_the_index_at_the_threshold(spark):
    """Items whose words are edited until the similarity is just above 0.8: what the index finds of them."""
    items, texts = [], []
    r = random.Random(8)
    for i in range(400):
        w = some(60 + i % 60, 100 + i)
        items.append((i, " ".join(w)))
        places = list(range(0, len(w), 1))
        r.shuffle(places)
        edited = list(w)
        at = r.randrange(10, len(w) - 10)
        edited[at] = "edited"  # five shingles of each bag differ by one word within
        drop = max(0, int(0.09 * len(w)) - 5)
        texts.append((i, " ".join(edited[drop:])))
    bench, docs = spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(texts, "doc_id bigint, text string")
    want = set()
    for (i, a), (_, b) in zip(items, texts, strict=True):
        x, y = ({tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for t in (a, b))
        if len(x & y) >= 0.8 * len(x | y):
            want.add(i)
    got = {r.doc_id for r in decontam.contaminated(docs, bench).where("doc_id = item_id").collect()}
    assert len(want) > 200 and len(got & want) >= 0.99 * len(want) and got <= want


def test_index_prunes(spark):
    fps = spark.range(300).select(F.lit(7).alias("n"), F.xxhash64("id").alias("fp"), F.col("id").alias("i"))
    other = spark.range(1000, 1300).select(F.lit(7).alias("n"), F.xxhash64("id").alias("fp"))
    met = decontam.in_blocks(other, 2).join(decontam.in_blocks(fps, 2, "i").withColumnRenamed("fp", "ifp"), ["n", "block", "value"]).select("fp", "i").distinct()
    assert met.count() < 0.2 * 300 * 300
