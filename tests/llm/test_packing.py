"""Packing against best fit document by document, ids against the tokenizers library, and the layout of sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agrispark.llm import packing as P

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def one_by_one(sizes, length):
    """Remaining capacities after best fit, longest first, one document at a time."""
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - s)
        else:
            free.append(length - s)
    return Counter(free)


def placed(histogram, length):
    rules, sequences = P.best_fit(histogram, length)
    fill, got = defaultdict(list), Counter()
    for n, (size, first, to, each, offset) in enumerate(rules):
        last = rules[n + 1][1] if n + 1 < len(rules) and rules[n + 1][0] == size else histogram[size]
        for k in range(last - first):
            fill[to + k // each].append((offset + k % each * size, size))
            got[size] += 1
    assert got == Counter(histogram) and set(fill) == set(range(sequences))
    free = Counter()
    for own in fill.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
        free[length - at] += 1
    return free


@pytest.mark.parametrize("length", [1, 7, 64, 1000])
def test_best_fit_is_that_of_single_documents(length):
    rng = random.Random(length)
    for n in (0, 1, 5, 60, 400):
        for top in {1, max(1, length // 3), length}:
            sizes = [rng.randint(1, top) for _ in range(n)] + [rng.randint(1, top)] * (n // 3)
            assert placed(Counter(sizes), length) == one_by_one(sizes, length)


def test_tightest_capacity():
    rng = random.Random(3)
    tree, is_open = P.Capacities(100), set()
    for _ in range(3000):
        c = rng.randint(0, 100)
        tree.set(c, now := rng.random() < 0.3)
        (is_open.add if now else is_open.discard)(c)
        need = rng.randint(0, 100)
        assert tree.tightest(need) == min((x for x in is_open if x >= need), default=None)


def test_cuts():
    assert P.cuts(1, 4) == [(0, 1)] and P.cuts(4, 4) == [(0, 4)] and P.cuts(8, 4) == [(0, 4), (4, 4)] and P.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def checked(rows, texts, length):
    """Pieces of texts (in order of ids) against the other library, and gapless sequences."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, text in texts:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, P.END], "<u4")
        want[i] += [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(P.cuts(len(ids), length))]
        assert len(ids) == sum(n for _, n in P.cuts(len(ids), length))
    assert {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) for i, own in by.items()} == {i: sorted(w) for i, w in want.items()}
    free = Counter()
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
        free[length - at] += 1
    assert free == one_by_one([r["length"] for r in rows], length)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = P.op13_best_fit_packing(spark, "/root/testdata/sf0.01").collect()
    checked(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], P.LENGTH)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_nulls_repeats_long_texts(spark, monkeypatch, kind):
    monkeypatch.setattr(P, "BUCKET", 10)
    rng = random.Random(1)
    odd = [None, "", " ", "\n\n  x", "<|endoftext|> it's", "日本語 ñandú İ ǅ 𝒳 👩‍👩‍👧\u0085 ", "a" * 30_000, "word " * 20_000, "same text"]
    texts = [(rng.choice([None, 1, 2, k]), rng.choice(odd)) for k in range(150)] + [(7, "same text")] * 60
    texts = [(i if kind == "long" or i is None else str(i), t) for i, t in texts]
    df = spark.createDataFrame([(*t, 5, "x") for t in texts], f"doc_id {kind}, text string, length int, number string").repartition(5)
    parts = P.pieces(df, RANKS, length=100, ids=True)
    checked(P.packed(P.written(parts.drop("ids"), "p"), 100).collect(), texts, 100)
    sums = parts.where("size(ids) <> length").count()
    assert sums == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.packed(P.written(P.pieces(df, RANKS), "p")).count() == 0


def test_reruns_agree(spark):
    runs = [P.op13_best_fit_packing(spark, "/root/testdata/sf0.001").agg(F.sum(F.xxhash64("doc_id", "piece", "sequence_id", "offset").cast("decimal(38,0)"))).first()[0] for _ in range(2)]
    assert runs[0] == runs[1]
