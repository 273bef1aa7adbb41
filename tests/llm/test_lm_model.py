"""The language model: proper probabilities, gradient sums, independence of partitions, edge cases, held-out likelihood."""

import math

import numpy as np
from pyspark.sql import functions as F

from agrispark.llm import maxent

SF = "/root/testdata/sf0.001"


def test_probabilities_sum_to_one():
    """Over all words of a small vocabulary and an unseen rest, after any context."""
    weights = np.random.default_rng(1).normal(size=(maxent.TABLE, maxent.CLASSES)).astype(np.float32)
    ids, sizes = maxent.encoded([b"a b c d e f g a c"])
    for slots in maxent.context_slots(ids, sizes):
        _, e, total = maxent.shares(weights, slots)
        assert np.allclose((e / total[:, None]).sum(axis=1), 1)
    first, second = maxent.context_slots(ids, sizes)
    assert first.max() == maxent.CLASS_SLOTS and second.min() >= maxent.PARTS_AT and second.max() < maxent.TABLE


def test_expected_and_observed_counts_equal_plain_sums():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(maxent.TABLE, maxent.CLASSES)).astype(np.float32)
    ids, sizes = maxent.encoded([b"the cat the dog the cat sat " * 40, b"", b"dog"])
    leaves = maxent.leaves_of(ids)
    for slots, outcomes in zip(maxent.context_slots(ids, sizes), (leaves // maxent.CLASSES, leaves % maxent.CLASSES)):
        want, seen, got = np.zeros((maxent.TABLE, maxent.CLASSES)), np.zeros((maxent.TABLE, maxent.CLASSES)), np.zeros((maxent.TABLE, maxent.CLASSES))
        for t in range(len(ids)):
            z = weights[slots[:, t]].astype(float).sum(axis=0)
            for row in slots[:, t]:
                want[row] += np.exp(z) / np.exp(z).sum()
                seen[row, outcomes[t]] += 1
        maxent.add_expected(got, weights, slots)
        assert np.allclose(got, want, atol=1e-3) and (maxent.observed(slots, outcomes) == seen).all()


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = ({r.doc_id: r.score for r in maxent.scored(docs.repartition(n)).collect()} for n in (1, 8))
    assert one.keys() == many.keys() and all(math.isclose(one[i], many[i], rel_tol=1e-5) for i in one)


def test_context_tells_words_apart(spark):
    """A word that always follows another is likelier after it than elsewhere, also against words of its class and part."""
    text = "red apple green pear " * 20
    docs = spark.createDataFrame([(i, text) for i in range(60)] + [(1000, "red apple green pear"), (1001, "red pear green apple")], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in maxent.scored(docs).collect()}
    assert got[1000] > got[1001] + 0.5


def test_repeats_nulls_empty_training_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b a"), (1, "a b a"), (None, None), (None, "x"), (2, "")], "doc_id bigint, text string").selectExpr("*", "1 as chunk", "2 as id", "3 as round")
    got = maxent.scored(docs).collect()
    assert len(got) == 5 and sorted(r.n_tokens for r in got) == [1, 1, 2, 4, 4]
    held = next(i for i in range(100) if maxent.is_held_out(i))
    r = maxent.scored(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")).first()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and r.held_out and math.isfinite(r.score)


def test_scores_from_the_weights_token_by_token(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    weights = maxent.trained(docs, "doc_id", "text")
    got = {r.doc_id: r for r in maxent.scored(docs).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    counts = {}
    for i, t in texts.items():
        if not maxent.is_held_out(i):
            for h in maxent.encoded([t])[0].tolist():
                counts[h] = counts.get(h, 0) + 1
    size = {}
    for h, c in counts.items():
        leaf = int(maxent.leaves_of(np.array([h], np.uint64))[0])
        tokens, types = size.get(leaf, (0, 0))
        size[leaf] = (tokens + c, types + 1)
    for i in sorted(texts)[:12]:
        ids, sizes = maxent.encoded([texts[i]])
        leaves, total = maxent.leaves_of(ids), 0.0
        for slots, outcomes in zip(maxent.context_slots(ids, sizes), (leaves // maxent.CLASSES, leaves % maxent.CLASSES), strict=True):
            for t in range(len(ids)):
                z = sum(weights[row].astype(float) for row in slots[:, t])
                total += (z[outcomes[t]] - math.log(sum(math.exp(x - z.max()) for x in z)) - z.max()) / math.log(10)
        total += sum(math.log10(counts.get(h, 0) + 1) - math.log10(sum(size.get(int(k), (0, 0))) + 1) for h, k in zip(ids.tolist(), leaves, strict=True))
        assert math.isclose(got[i].score, total, rel_tol=1e-4, abs_tol=1e-3), i


def test_ids_that_are_no_numbers_and_long_texts(spark):
    docs = spark.createDataFrame([("a", "x y z"), ("b", "x y z"), (None, "x y"), ("7", "word " * 60_000), (None, None)], "doc_id string, text string")
    got = {(r.doc_id, r.n_tokens): r for r in maxent.scored(docs).collect()}
    assert set(got) == {("a", 4), ("b", 4), (None, 3), ("7", 60_001), (None, 1)} and all(math.isfinite(r.score) for r in got.values())


def test_expected_counts_are_summed_in_doubles():
    weights = np.random.default_rng(3).normal(size=(maxent.TABLE, maxent.CLASSES)).astype(np.float32)
    ids, sizes = maxent.encoded([b"the cat sat on the mat " * 10_000])
    for slots in maxent.context_slots(ids, sizes):
        want, got = np.zeros((2, maxent.TABLE, maxent.CLASSES))
        for k in range(0, slots.shape[1], maxent.STEP_TOKENS):
            part = slots[:, k : k + maxent.STEP_TOKENS]
            _, p, total = maxent.shares(weights, part)
            for column in part:
                np.add.at(want, column, (p / total[:, None]).astype(float))
        maxent.add_expected(got, weights, slots)
        assert np.allclose(got, want, rtol=1e-10, atol=1e-9)


def test_a_round_has_a_third_of_the_tasks_and_all_of_its_rows(spark):
    """Each task of a round shuffles sums of a fixed size."""
    rows = spark.range(3000, numPartitions=60).withColumn("round", F.col("id") % maxent.ROUNDS)
    parts = [maxent.of_round(rows, r) for r in range(maxent.ROUNDS)]
    assert [p.rdd.getNumPartitions() for p in parts] == [20] * maxent.ROUNDS
    assert sorted(r.id for p in parts for r in p.collect()) == list(range(3000))
    assert maxent.of_round(rows.coalesce(9), 0).rdd.getNumPartitions() == min(9, max(3, spark.sparkContext.defaultParallelism))
