"""The n-gram join on large groups: similar texts under the threshold, hot shingles, ids that are null or repeat."""

import random
from itertools import combinations

import pytest

from agrispark.llm import ngram_join
from test_llm import components, shingle_sets

SCHEMA = "doc_id bigint, text string, key string, n bigint, token int"


def group(n, edits, seed, size=60):
    """Texts that share most words with one another, many of them not enough for a link."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(size)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def expected(texts, k, num):
    sets = shingle_sets(texts, k)
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return [len(s) for s in sets], components(len(texts), links)


@pytest.mark.parametrize("hot,block", [(32_000, 1_000_000), (20, 2_000)])
def test_groups_equal_brute_force(spark, monkeypatch, hot, block):
    if hot < 100:  # many groups of a hot shingle, though the table is small
        monkeypatch.setattr(ngram_join, "ROWS_A_BUCKET", 100)
    texts = group(260, 6, 1) + group(60, 12, 2) + [t + " " + " ".join(group(1, 1, 50 + i, 20)) for i, t in enumerate(group(60, 3, 3, 90))]
    sizes, want = expected(texts, 4, 85)
    docs = spark.createDataFrame([(i, t, "x", 7, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, 4, 85, 100, hot=hot, block=block).collect()}
    assert got == {i: (sizes[i], want[i]) for i in range(len(texts))}
    assert len(set(want)) > 20


def test_null_and_repeated_ids(spark):
    base = group(1, 1, 9)[0]
    near = base + " tail"
    rows = [(None, base), (None, near), (None, "alone among all these words"), (7, base), (7, "another text under the same id"), (3, near), (9, near), (9, near)]
    docs = spark.createDataFrame([(i, t, "x", 7, 0) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, 4, 85, 100).collect()), key=str)
    n = len(base.split()) - 3
    assert got == sorted([(None, n, 3), (None, n + 1, 3), (None, 2, None), (7, n, 3), (7, 3, 7), (3, n + 1, 3), (9, n + 1, 3), (9, n + 1, 3)], key=str)
